"""Site configuration: identifiers and override tables an operator of the marts supplies.

Defaults are the public values the marts were specified with.  Names of staff are
left empty on purpose; pass them in through :class:`SiteConfig`.
"""

from __future__ import annotations

from dataclasses import dataclass, field


# Identifiers, dates and labels of the marts' specification.
@dataclass(frozen=True)
class SiteConfig:
    # Word that fills the "{brand}" slot of the status tokens.
    brand: str = "platform"

    # Lenders that decide the portfolio label, most important first.
    priority_lenders: tuple = ((1983451, "FD"), (4297499, "INDMoney"), (5046222, "MLP"))
    # The collection mart only knows the first two.
    collection_lenders: tuple = ((1983451, "FD"), (4297499, "INDMoney"))
    other_portfolio: str = "Non-FD"
    tracked_lender: int = 1983451

    # Actors that are machines, payees that are not borrowers.
    system_actors: tuple = (0, 1)
    ignored_payees: tuple = (8888888888, 9999999999, 7777777777, 6666666666, 5555555555, 222222221)

    # Portfolio used when no proposal carries one.
    default_portfolio_from: str = "2020-09-01"
    default_portfolio: str = "FD"
    partner_source: str = "IMB"
    partner_portfolio: str = "INDMoney"
    co_lender_excluded_loans: tuple = (1005216551, 1005249730, 1005249824)

    # sub_category -> agent label.
    agent_by_sub_category: dict = field(default_factory=lambda: {
        "Fintranxect": "Fcpartner_Fintranxect_Digital",
        "FinnovIndia": "Fcpartner_Finnov_India_Development_Center_Pvt_Ltd",
        "Smrll Finance": "Fcpartner_Smrll",
        "Freemi": "Fcpartner_Ntactus_Financial",
        "Atlanta Group": "Fcpartner_Atlanta_Group",
        "Abhay": "Fcpartner_Abhayinfosys",
        "Bikash": "Fcpartner_Bikash_Pal",
        "Amit_Hooda": "Fcpartner_Rokdaa",
        "Destinyservices": "Fcpartner_Destinyentiresolution",
        "Easyloan": "Fcpartner_Easyloancentre In",
        "Financialpatron": "Fcpartner_Patron_Financial",
        "Kkgroup": "Fcpartner_Kk_Group_India",
        "Kps Ghiri": "Fcpartner_Kpsghiri",
        "Moneycircle": "Fcpartner_Moneycircle",
        "Gurufinserv": "Fcpartner_Guru Finance Nanded",
        "Rajput Finance": "Fcpartner_Rajput_Finance",
        "Singhfinserv": "Fcpartner_Singh Finance85",
        "Gopalk": "Fcpartner_Gopalkadam007",
        "Viinome Advisors Pvt. Ltd.": "Fcpartner_Viinome",
        "Finlead Financial Advisory": "Fcpartner_Finlead_Financial_Advisory",
        "Creditenable": "Fcpartner_Oktober6",
        "Kriti Financial Services": "Fcpartner_Kriti",
    })
    # sub_category that is its own agent label.
    agent_is_sub_category: tuple = (
        "Afinoz", "Paisagrowth", "Moneyloji", "Onecode", "Lending Adda",
        "Way2Online", "Ls", "Navigant", "Bookmyfinance",
    )
    # agent label -> (channel, sub_category, category).
    channel_by_agent: dict = field(default_factory=lambda: {
        "Fcpartner_Openbank": ("Aggregator", "Fcpartner_Openbank", "Aggregator"),
        "Fcpartner_Earnwealth_Solutions": ("Aggregator", "Earnwealth", "Aggregator"),
        "Fcpartner_Dtpl": ("Aggregator", "Droom", "Aggregator-Two Wheeler"),
        "Fcpartner_Parvatiraut": ("DSA Partner", "Fcpartner_Parvatiraut", "DSA"),
    })
    agent_channel: tuple = ("DSA Partner", "DSA")          # channel, category
    organic_channel: str = "Marketing"
    partner_channel: tuple = ("Aggregator", "IndMoney", "Aggregator")

    # Representative overrides, applied after agents and source owners.
    rep_by_sub_category: dict = field(default_factory=dict)
    rep_by_channel: dict = field(default_factory=lambda: {"Marketing": "Call_Center"})

    # First registration date that belongs to the lead funnel.
    funnel_from: str = "2024-01-01"

    def fill(self, tokens):
        """Put the brand word into a list of status tokens or action names."""
        return [t.replace("{brand}", self.brand).replace("{BRAND}", self.brand.upper()) for t in tokens]


DEFAULT_SITE = SiteConfig()
