"""Personal data: spans proposed by regular expressions, confirmed by checksums, scored by the words around them.

Base kinds (email, ip, card, phone) have fixed patterns and checks; every match that passes its check is reported.
The method adds kinds of its own: bank account numbers (IBAN, confirmed by mod 97 and their country's length), social security
numbers (confirmed by their number ranges) and secrets (keys and tokens, proposed by known beginnings or by the name they are assigned
to, confirmed by the entropy of their characters); an added span must reach ``ADDED_SCORE`` after the words around it have raised or
lowered its score.  Base spans carry a score as well, for callers who want to be stricter.

Positions come from cutting the text at the pattern: the lengths of the pieces between the matches and of the
matches themselves add up to code point offsets.  Patterns are written so that a run of characters is tried once: a look-behind
(or the end of the last match) fixes where a run begins and possessive quantifiers never give back, which changes
no match but keeps very long runs linear and off the stack.  A text without a kind's telling character
skips the pattern.  Where an IBAN ends cannot be seen by a run of characters, since words and numbers may follow it after one
blank: its pattern proposes the country and check digits only, and of the group borders that may end it the longest that passes is taken.

All steps are DataFrame functions.

Defined cases: a null or empty text has no spans; spans of different kinds may overlap and are all reported; repeated
rows are searched alike; an empty table gives an empty result; the input's columns stay, whatever their names, and the caller names the new
one (a column of that name is replaced).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmart.llm.texts import free_names, lower_ascii, text_of

CONTEXT_CHARS = 40
ADDED_SCORE = 0.5
WORD_WEIGHT = 0.35


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: what proposes it, what must be in the text, and how sure a match is."""
    name: str
    pattern: str
    needs: str
    base: bool
    score: float
    # Words near the match, any case, that speak for it or against it.
    words_for: str
    words_against: str


# In the order in which spans that begin together are listed.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", True, 0.9,
         "mail|contact|write|reach", "example|noreply|no-reply"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", True, 0.6,
         "ip|address|host|server|login|client", "version|release|build|section|chapter"),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", "", True, 0.8,
         "card|visa|master|amex|credit|debit|payment|pay", "order|invoice|tracking|isbn|serial"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", True, 0.7,
         "phone|call|tel|mobile|fax|cell|whatsapp", "version|score|rate"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9]{4} ?[A-Z0-9]{4})", "", False, 0.8,
         "iban|account|bank|transfer|konto|compte|cuenta", "serial|part|model"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", False, 0.3,
         "ssn|social|security|taxpayer", "order|invoice|part|serial"),
    # Whole words only; the name in front of a value is looked for only where a word is long enough to be one.
    Kind("secret", r"(?<![A-Za-z0-9_+/.-])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,255}+|sk-[A-Za-z0-9_-]{20,255}+|xox[abprs]-[A-Za-z0-9-]{10,255}+"
         r"|AIza[A-Za-z0-9_-]{35}|(?=[A-Za-z0-9_+/.-][A-Za-z0-9_+/=.-]{15})"
         r"(?<=(?i:token|secret|password|passwd|api.?key|access.?key|private.?key|credentials?)[\"']{0,1}[ \t]{0,3}[:=]{1,2}[ \t]{0,3}[\"']{0,1})[A-Za-z0-9_+/=.-]{16,255}+)"
         r"(?![A-Za-z0-9_+/=.-])", "", False, 0.7, "token|secret|password|key|credential|auth", "sha|checksum|digest|commit|hash"),
)
SECRET_BITS = 3.0  # entropy of a secret's characters

# Characters of an IBAN by country; codes not listed may have any length from 15 to 34.
IBAN_LENGTHS = {country: int(n) for country, n in map(str.split, """
AD 24,AE 23,AL 28,AT 20,AZ 28,BA 20,BE 16,BG 22,BH 22,BI 27,BR 29,BY 28,CH 21,CR 22,CY 28,CZ 24,DE 22,DJ 27,DK 18,DO 28,EE 20,EG 29,ES 24,FI 18,FK 18,FO 18,
FR 27,GB 22,GE 22,GI 23,GL 18,GR 27,GT 28,HN 28,HR 21,HU 28,IE 22,IL 23,IQ 23,IS 26,IT 27,JO 30,KW 30,KZ 20,LB 28,LC 32,LI 21,LT 20,LU 20,LV 21,LY 25,MC 27,
MD 24,ME 22,MK 19,MN 20,MR 27,MT 31,MU 30,NI 28,NL 18,NO 15,OM 23,PK 24,PL 28,PS 29,PT 25,QA 29,RO 24,RS 22,RU 33,SA 24,SC 31,SD 18,SE 24,SI 19,SK 24,SM 27,
SO 23,ST 25,SV 28,TL 23,TN 24,TR 26,UA 29,VA 22,VG 24,XK 20,YE 30""".split(","))}
IBAN_GROUPS, IBAN_CHARS = range(7, 1, -1), 4 + 7 * 5 + 4  # groups of four after the head; the most characters with blanks

SPAN = "array<struct<start:int,rank:int,kind:string,end:int,text:string,score:double>>"


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Every second digit from the right doubled and reduced; the sum is a multiple of ten."""
    backwards = F.split(F.reverse(digits), "")
    values = F.transform(backwards, lambda d, k: (
        d.cast("int") * (k % 2 + 1) - F.when((k % 2 == 1) & (d.cast("int") > 4), 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def passes_mod97(match: Column) -> Column:
    """The first four characters go to the end, letters count from 10; the number leaves 1."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    step = F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))
    return F.char_length(plain).between(15, 34) & (step == 1)


def right_length(match: Column) -> Column:
    """As long as the country's numbers are, where the country is known."""
    lengths = F.create_map(*(F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair))
    plain = F.replace(match, F.lit(" "), F.lit(""))
    return F.coalesce(F.try_element_at(lengths, F.substr(plain, F.lit(1), F.lit(2))) == F.char_length(plain), F.lit(True))


def whole_ibans(text: Column, heads: Column) -> Column:
    """Spans that begin with ``heads`` and end at the last group border that confirms them; none begins inside the one before."""
    def whole(s: Column) -> Column:
        run = F.substr(text, s["start"] + 1, F.lit(IBAN_CHARS + 1))
        ends = F.array(*(F.regexp_extract(run, "^[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){%d}%s(?![A-Za-z0-9])" % (n, tail), 0)
                         for n in IBAN_GROUPS for tail in ("(?: ?[A-Z0-9]{1,3})", "")))
        good = F.get(F.filter(ends, lambda m: passes_mod97(m) & right_length(m)), F.lit(0))
        return s.withField("text", good).withField("end", s["start"] + F.char_length(good))

    good = F.filter(F.transform(heads, whole), lambda s: s["text"].isNotNull())
    return F.aggregate(good, F.array().cast(SPAN), lambda a, s: F.when(
        F.coalesce(F.get(a, F.size(a) - 1)["end"] <= s["start"], F.lit(True)), F.array_append(a, s)).otherwise(a))


def confirmed(kind: str, match: Column) -> Column:
    """The check a match has to pass."""
    if kind == "ip":
        return match.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|(?<=0))(?:\.|$)){4}$")
    if kind == "card":
        return F.char_length(digits_of(match)).between(14, 19) & passes_luhn(digits_of(match))
    if kind == "phone":
        return F.char_length(digits_of(match)).between(10, 15)
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9)|-00-|-0000$")
    if kind == "secret":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]") & (entropy(match) >= SECRET_BITS)
    return F.lit(True)


def entropy(match: Column) -> Column:
    """Bits a character, from how often each stands in the match."""
    n = F.char_length(match).cast("double")
    share = lambda c: (n - F.char_length(F.replace(match, c, F.lit("")))) / n
    return F.aggregate(F.array_distinct(F.split(match, "")), F.lit(0.0), lambda bits, c: bits - F.when(c != "", share(c) * F.log2(share(c))).otherwise(F.lit(0.0)))


def proposed(text: Column, kind: Kind) -> Column:
    """All matches of the kind's pattern; null where its telling character is missing."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    return F.when(F.contains(text, F.lit(kind.needs)), matches) if kind.needs else matches


def spans_of(text: Column, matches: Column, kind: Kind, rank: int) -> Column:
    """The confirmed ones of ``matches`` with their places, in order."""
    # Lengths of the pieces between matches and of the matches in turn, summed up to each match.
    lengths = F.zip_with(F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(matches)), matches,
                         lambda p, m: F.struct(F.char_length(p).alias("p"), F.char_length(m).alias("m")))
    starts = F.aggregate(
        lengths, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda a, x: F.struct((a["at"] + x["p"] + x["m"]).alias("at"), F.array_append(a["starts"], a["at"] + x["p"]).alias("starts")),
        lambda a: a["starts"])
    spans = F.zip_with(starts, matches, lambda s, m: F.struct(
        s.alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"),
        (s + F.char_length(m)).alias("end"), m.alias("text"), F.lit(kind.score).alias("score")))
    good = whole_ibans(text, spans) if kind.name == "iban" else F.filter(spans, lambda s: confirmed(kind.name, s["text"]))
    scored = F.transform(good, lambda s: s.withField("score", score(text, s, kind)))
    kept = scored if kind.base else F.filter(scored, lambda s: s["score"] >= ADDED_SCORE)
    return F.coalesce(F.when(F.size(matches) > 0, kept), F.array().cast(SPAN))


def score(text: Column, span: Column, kind: Kind) -> Column:
    """The kind's score, moved by words within ``CONTEXT_CHARS`` before or behind the span."""
    first = F.greatest(span["start"] - CONTEXT_CHARS, F.lit(0))
    around = lower_ascii(F.concat_ws(
        " ", F.substr(text, first + 1, span["start"] - first), F.substr(text, span["end"] + 1, F.lit(CONTEXT_CHARS))))
    speaks = lambda words: around.rlike(rf"(?<![a-z])(?:{words})").cast("int")
    moved = F.lit(kind.score) + WORD_WEIGHT * speaks(kind.words_for) - WORD_WEIGHT * speaks(kind.words_against)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), moved)), 2)


def find_spans(docs: DataFrame, into: str = "pii", text: str = "text") -> DataFrame:
    """``docs`` with all confirmed spans, by start and then by kind, in the array column ``into``."""
    whole = text_of(text)
    # Matches are columns of a step of their own, so that no pattern runs twice for the expressions that use them.
    names = free_names([*docs.columns, into], *(f"proposed_{k.name}" for k in KINDS))
    tried = docs.withColumns({n: proposed(whole, k) for n, k in zip(names, KINDS)})
    found = F.concat(*(spans_of(whole, F.col(n), k, i) for i, (n, k) in enumerate(zip(names, KINDS))))
    return tried.withColumn(into, F.array_sort(found)).drop(*names)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
