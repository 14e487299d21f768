"""Plain versions of the operators, text by text, to hold results against."""

import hashlib
import math
import re
from collections import Counter, defaultdict

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text):
    """Base spans ``(start, rank, kind, end)`` in order."""
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m)
    checks = [("email", EMAIL, lambda m: True), ("ip", IP, lambda m: all(int(p) <= 255 for p in m.split("."))),
              ("card", CARD, lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
              ("phone", PHONE, lambda m: 10 <= len(digits(m)) <= 15)]
    return sorted((m.start(), r, kind, m.end()) for r, (kind, p, good) in enumerate(checks) for m in re.finditer(p, text) if good(m[0]))


def pii_row(text):
    spans = pii(text)
    listed = ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)
    return tuple(sum(x[2] == k for x in spans) for k in ("email", "ip", "card", "phone")) + (hashlib.sha256(listed.encode()).hexdigest(),)


def ibans(text, lengths):
    """IBAN spans ``(start, end)``: every start and every end is tried, the longest first."""
    out, at = [], 0
    for m in re.finditer(r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})", text):
        for end in range(min(len(text), m.start() + 43), m.start(), -1):
            plain = text[m.start():end].replace(" ", "")
            if m.start() < at or not re.fullmatch(r"[A-Z0-9]{4}( ?[A-Z0-9]{4}){2,7}( ?[A-Z0-9]{1,3})?", text[m.start():end]) \
                    or re.match("[A-Za-z0-9]", text[end:]) or lengths.get(plain[:2], len(plain)) != len(plain) or not 15 <= len(plain) <= 34:
                continue
            if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                out.append((m.start(), end))
                at = end
                break
    return out


def discounts(counts):
    """Modified Kneser-Ney discounts from a collection of counts."""
    n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    return [0] + [min(max(k - (k + 1) * y * (n[k] / n[k - 1] if n[k - 1] else 0.5), 0.05), k - 0.05) for k in (1, 2, 3)]


def language_model(rows, order):
    """``rows``: (text, train) -> per row (n_tokens, n_known, base, score), the model as a function p(w | u v), tokens, words."""
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["</s>"] for t, _ in rows]
    grams = lambda ws: zip([None, "<s>", *ws], ["<s>", *ws], ws)
    three, single = Counter(), Counter()
    for ws, (_, train) in zip(tokens, rows):
        if train:
            three.update(grams(ws))
            single.update(ws)
    two, count = Counter((v, w) for _, v, w in three), Counter()
    for (_, v, w), c in three.items():
        count[v, w] += c
    if order == 2:
        two = count
    else:
        two = Counter({k: count[k] if k[0] == "<s>" else n for k, n in two.items()})
    seen = Counter(w for _, w in two)

    def contexts(counts):
        sums, kinds = Counter(), defaultdict(lambda: [0, 0, 0, 0])
        for gram, c in counts.items():
            sums[gram[:-1]] += c
            kinds[gram[:-1]][min(c, 3)] += 1
        return sums, kinds, discounts(counts.values())

    d1 = discounts(seen.values())
    total, size = len(two), len(single)
    free = sum(d1[min(a, 3)] for a in seen.values()) / total if total else 1
    levels = [(two, *contexts(two)), (three, *contexts(three))]

    def p(u, v, w):
        a = seen[w]
        low = (a - d1[min(a, 3)] if a else 0) / max(total, 1) + free / (size + 1)
        for (counts, sums, kinds, d), gram in zip(levels[:order - 1], ((v, w), (u, v, w))):
            of = gram[:-1]
            if sums[of]:
                c = counts[gram]
                low = (c - d[min(c, 3)] if c else 0) / sums[of] + sum(x * k for x, k in zip(d, kinds[of])) / sums[of] * low
        return low

    n = sum(single.values())
    out = [(len(ws), sum(single[w] > 0 for w in ws), sum(math.log10((single[w] + 1) / (n + size + 1)) for w in ws),
            sum(math.log10(p(*g)) for g in grams(ws))) for ws in tokens]
    return out, p, n, set(single)


BLANK = r"[^\x20\x09-\x0D]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = re.findall(BLANK, text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(BLANK, x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def simhash(text, xxh64):
    words = re.findall(BLANK, lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxh64(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=3):
    """Smallest id reachable for each ``(id, fingerprint)``."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        least[find(i)] = min(d, least.get(find(i), d))
    return [least[find(i)] for i in range(len(prints))]


def best_fit_decreasing(lengths, row):
    room = []
    out = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [(r, k) for k, r in enumerate(room) if r >= lengths[i]]
        if fits:
            least = min(fits)[0]
            k = [k for r, k in fits if r == least][-1]
        else:
            k = len(room)
            room.append(row)
            out.append([])
        room[k] -= lengths[i]
        out[k].append(i)
    return sorted(room), out
