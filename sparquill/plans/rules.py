"""Rule sets as data: what routes, guards and boosts are parameterised with."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Router:
    """Sources in order with their prior shares, keywords, the core source with its anchors, explicit references in order."""

    priors: dict[str, float]
    keywords: dict[str, tuple[str, ...]]
    core: str
    anchors: tuple[str, ...] = ()
    explicit: tuple[tuple[str, str], ...] = ()
    numbers: tuple[tuple[str, str], ...] = ()
    anchor_bonus: int = 3
    core_share: float = 0.9
    other_prior: float = 0.1

    @property
    def sources(self) -> tuple[str, ...]:
        return tuple(self.keywords)

    def loaded(self, keywords: dict[str, tuple[str, ...]]) -> Router:
        """With keyword lists read from elsewhere; a list replaces its source's, it does not add to it."""
        return replace(self, keywords=self.keywords | keywords)


@dataclass(frozen=True)
class Profile:
    """How the hits of several sources are merged."""

    total_k: int = 10
    min_k: int = 2
    min_score: float = 0.5
    threshold_after: bool = False
    router_bonus: float = 0.0
    guards: tuple[tuple[str, str, float], ...] = ()
    mismatch_penalty: float = 0.0
    mismatch_terms: tuple[str, ...] = ()
    diversity_gap: float | None = None
    limit: int = 10


@dataclass(frozen=True)
class Boosts:
    """Rules (terms, section, moment or None, +) and (terms, section, -), and the anchor overlap's limits."""

    boosts: tuple[tuple[tuple[str, ...], str, str | None, float], ...]
    penalties: tuple[tuple[tuple[str, ...], str, float], ...] = ()
    overlap_terms: tuple[str, ...] = ()
    overlap_sections: tuple[str, ...] = ()
    overlap_unit: float = 0.01
    overlap_most: float = 0.05
    cap_share: float = 0.05


@dataclass(frozen=True)
class Gate:
    name: str
    metric: str
    op: str
    threshold: float
    required: bool = True


# The statutes' router keywords, anchors, references, priors and pair guards.
STATUTES = Router(
    priors={
        "kuntalaki_410_2015": 0.40,
        "kirjanpitolaki_1336_1997": 0.15,
        "kirjanpitoasetus_1339_1997": 0.10,
        "tilintarkastuslaki_1141_2015": 0.15,
        "hankintalaki_1397_2016": 0.15,
        "osakeyhtiolaki_624_2006": 0.05,
    },
    keywords={
        "kuntalaki_410_2015": ("kunta", "kunnan", "valtuusto", "kunnanhallitus", "kunnanjohtaja", "kriisikunta", "arviointimenettely", "kuntayhtymä", "konserni", "kuntakonserni", "kuntalaki", "tarkastuslautakunta", "kuntalain", "kuntien", "kuntalainen", "kunnanvaltuusto"),
        "kirjanpitolaki_1336_1997": ("tase", "liitetiedot", "tuloslaskelma", "poistot", "arvostus", "kirjanpito", "tilivuosi", "tilikausi"),
        "kirjanpitoasetus_1339_1997": ("kirjanpitoasetus", "tasekaava", "tuloslaskelmakaava", "liitetieto", "esittämistapa", "erittely", "tase-erittelyt", "konsernitase", "konsernituloslaskelma", "rahoituslaskelma", "rahavirta", "kassavirta"),
        "tilintarkastuslaki_1141_2015": ("tilintarkastaja", "tilintarkastuskertomus", "huomautus", "vastuuvapaus", "tarkastuskertomus"),
        "hankintalaki_1397_2016": ("hankinta", "kilpailutus", "kynnysarvo", "tarjous", "sopimuskausi", "julkinen hankinta"),
        "osakeyhtiolaki_624_2006": ("konserniyhtiö", "osakeyhtiö", "yhtiökokous", "hallitus", "toimitusjohtaja", "osakepääoma"),
    },
    core="kuntalaki_410_2015",
    anchors=("kunnan", "kuntakonserni", "kuntalaki", "valtuusto", "kunnanhallitus", "tarkastuslautakunta", "kunnanjohtaja", "kunnanvaltuusto", "kuntalain"),
    explicit=(
        ("kpa", "kirjanpitoasetus_1339_1997"), ("kirjanpitoasetus", "kirjanpitoasetus_1339_1997"),
        ("kpl", "kirjanpitolaki_1336_1997"), ("kirjanpitolaki", "kirjanpitolaki_1336_1997"),
        ("oyl", "osakeyhtiolaki_624_2006"), ("osakeyhtiölaki", "osakeyhtiolaki_624_2006"),
        ("kuntalaki", "kuntalaki_410_2015"), ("kuntl", "kuntalaki_410_2015"),
        ("tilintarkastuslaki", "tilintarkastuslaki_1141_2015"), ("ttl", "tilintarkastuslaki_1141_2015"),
        ("hankintalaki", "hankintalaki_1397_2016"), ("julkisista hankinnoista", "hankintalaki_1397_2016"),
    ),
    numbers=(
        ("410/2015", "kuntalaki_410_2015"), ("1336/1997", "kirjanpitolaki_1336_1997"), ("1339/1997", "kirjanpitoasetus_1339_1997"),
        ("1141/2015", "tilintarkastuslaki_1141_2015"), ("1397/2016", "hankintalaki_1397_2016"), ("624/2006", "osakeyhtiolaki_624_2006"),
    ),
)
STATUTE_GUARDS = (
    ("kunnan", "kuntalaki_410_2015", 0.03),
    ("kunnan", "kirjanpitolaki_1336_1997", -0.03),
    ("kunta", "kuntalaki_410_2015", 0.02),
    ("kunta", "kirjanpitolaki_1336_1997", -0.02),
    ("konserni", "osakeyhtiolaki_624_2006", 0.02),
    ("tilintarkastaja", "tilintarkastuslaki_1141_2015", 0.02),
    ("hankinta", "hankintalaki_1397_2016", 0.02),
)
STATUTE_GUARDS_12 = (
    *STATUTE_GUARDS,
    ("kynnysarvo", "hankintalaki_1397_2016", 0.03),
    ("tarjous", "hankintalaki_1397_2016", 0.02),
    ("kilpailutus", "hankintalaki_1397_2016", 0.02),
    ("tasekaava", "kirjanpitoasetus_1339_1997", 0.03),
    ("tuloslaskelmakaava", "kirjanpitoasetus_1339_1997", 0.03),
)
STATUTE_GUARDS_14 = (
    *STATUTE_GUARDS_12,
    ("liitetietokaava", "kirjanpitoasetus_1339_1997", 0.02),
    ("erittelyt", "kirjanpitoasetus_1339_1997", 0.02),
)
STATUTE_NAMES = {
    "kuntalaki_410_2015": "Kuntalaki",
    "kirjanpitolaki_1336_1997": "Kirjanpitolaki",
    "kirjanpitoasetus_1339_1997": "Kirjanpitoasetus",
    "tilintarkastuslaki_1141_2015": "Tilintarkastuslaki",
    "hankintalaki_1397_2016": "Hankintalaki",
    "osakeyhtiolaki_624_2006": "Osakeyhtiölaki",
}
MUNICIPAL_ANCHORS = ("kunnan", "kunta", "kuntakonserni", "kuntalaki", "valtuusto", "kunnanhallitus", "tarkastuslautakunta", "kunnan tilinpäätös")
CHAPTER_TAGS = {
    "talous": ("talous", "budjetti", "rahoitus"),
    "kirjanpito": ("kirjanpito", "tilinpäätös", "laskentatoimi"),
    "tarkastus": ("tarkastus", "tilintarkastus", "valvonta"),
    "hallinto": ("hallinto", "organisaatio", "johtaminen"),
    "tase": ("tase", "vastaavaa", "vastattavaa", "tilinpäätös"),
    "tuloslaskelma": ("tuloslaskelma", "tuotot", "kulut", "tilinpäätös"),
    "liitetiedot": ("liitetiedot", "liitteet", "tilinpäätös"),
    "toimintakertomus": ("toimintakertomus", "raportointi", "tilinpäätös"),
    "arvostus": ("arvostus", "hankintameno", "käypä arvo"),
    "poisto": ("poisto", "hankintameno", "vaikutusaika"),
}
KEYWORD_TAGS = {
    "tilinpäätös": ("tilinpäätös", "kirjanpito", "raportointi"),
    "tilikausi": ("tilikausi", "tilivuosi", "vuosijakso"),
    "kirjanpitovelvollinen": ("kirjanpitovelvollinen", "velvollisuus"),
    "tase": ("tase", "vastaavaa", "vastattavaa"),
    "tuloslaskelma": ("tuloslaskelma", "tulos", "tilinpäätös"),
    "toimintakertomus": ("toimintakertomus", "raportointi"),
    "tilintarkast": ("tilintarkastus", "tarkastus", "valvonta"),
}
STATUTE_BOOSTS = Boosts(
    boosts=(
        (("tavoitteiden toteutuminen", "olennaiset tapahtumat", "olennaiset asiat", "tilikauden jälkeiset", "merkittävät tapahtumat", "tärkeät tapahtumat", "sisäinen valvonta", "sisäisen valvonnan", "riskienhallinta", "riskienhallinnan", "valvonta ja riskit", "kontrollit"), "115", "1", 0.04),
        (("alijäämäselvitys", "alijäämän kattamissuunnitelma", "talouden tasapainotus", "tasapainotuksen toteutuminen", "kattamaton alijäämä", "taseen alijäämä"), "115", "2", 0.04),
        (("tuloksen käsittely", "tilikauden tulos", "tuloskäsittely", "tuloskäsittelyesitys", "ylijäämän käyttö"), "115", "3", 0.04),
        (("toimintakertomuksessa", "toimintakertomuksen"), "115", None, 0.03),
        (("korona", "koronaepidemia", "covid", "covid-19", "pandemia", "epidemia", "poikkeus"), "110a", None, 0.05),
        (("yksittäisen kunnan", "ei konserni", "kunnan tilinpäätöksen asiakirjat"), "113", None, 0.05),
        (("kuntayhtymän eroaminen", "eroaminen kuntayhtymästä", "ei yhdistyminen", "ei jakautuminen"), "62", None, 0.08),
        (("alijäämän kattamatta", "määräajan ylitys", "kattamatta jättäminen"), "118", "2", 0.03),
        (("tunnusluku", "tunnusluvut", "raja-arvo", "raja-arvot", "kriteerit", "kriisikuntakriteerit"), "118", "3", 0.03),
        (("arviointiryhmä", "ryhmän asettaminen"), "118", "5", 0.03),
        (("arviointiryhmän ehdotukset", "ehdotusten käsittely"), "118", "6", 0.03),
    ),
    penalties=(
        (("korona", "koronaepidemia", "covid", "covid-19", "pandemia", "epidemia"), "110", -0.04),
        (("konserni", "konsernitilinpäätös", "kuntakonserni", "konsolidointi"), "113", -0.04),
        (("yksittäisen kunnan", "ei konserni", "kunnan tilinpäätös", "yksittäinen kunta"), "114", -0.05),
        (("talousarvion rakenne", "talousarvion osat", "taloussuunnitelman rakenne"), "113", -0.04),
        (("perussopimus", "perussopimuksen sisältö", "perussopimuksen muuttaminen"), "62", -0.05),
        (("perussopimus", "perussopimuksen sisältö", "perussopimuksen muuttaminen"), "62a", -0.05),
        (("perussopimus", "perussopimuksen sisältö", "perussopimuksen muuttaminen"), "62b", -0.05),
        (("eroaminen", "kuntayhtymästä eroaminen", "ei yhdistyminen"), "62a", -0.05),
        (("eroaminen", "kuntayhtymästä eroaminen", "ei jakautuminen"), "62b", -0.05),
        (("yhdistyminen", "kuntayhtymien yhdistyminen", "ei eroaminen"), "62", -0.05),
        (("yhdistyminen", "kuntayhtymien yhdistyminen"), "62b", -0.03),
        (("ei konserni", "yksittäisen kunnan", "yksittäinen kunta"), "114", -0.10),
        (("kuntayhtymän eroaminen", "eroaminen kuntayhtymästä", "ei yhdistyminen", "ei jakautuminen"), "62a", -0.10),
        (("kuntayhtymän eroaminen", "eroaminen kuntayhtymästä", "ei yhdistyminen", "ei jakautuminen"), "62b", -0.10),
    ),
    overlap_terms=("valvonta", "riski", "riskienhallinta", "alijäämä", "kattam", "tuloskäsittely", "konserni", "tavoitteiden", "olennaiset"),
    overlap_sections=("115", "110", "110a", "113", "114", "62", "62a", "62b", "118"),
)
PROBLEM_CATEGORIES = ("toimintakertomus", "covid-poikkeus", "arviointimenettely")
GATES_GOLDEN = (
    Gate("MUST >= 95%", "pass_rate_must", ">=", 0.95),
    Gate("TOTAL >= 90%", "pass_rate_total", ">=", 0.90),
    Gate("Latency < 150 ms", "avg_latency_ms", "<", 150),
)
GATES_V3 = (
    Gate("MUST >= 99%", "pass_rate_must", ">=", 0.99),
    Gate("MUST Top-1 >= 80%", "top1_hit_rate_must", ">=", 0.80),
    Gate("SHOULD >= 95%", "pass_rate_should", ">=", 0.95),
    *(Gate(f"{c} >= 90%", f"pass_rate_{c.replace('-', '_')}", ">=", 0.90) for c in PROBLEM_CATEGORIES),
    Gate("No hard negative violations", "hn_violations", "=", 0),
    Gate("Latency < 150 ms", "avg_latency_ms", "<", 150),
)
GATES_CROSS = (
    Gate("pass_rate_strict_95", "pass_rate_strict", ">=", 0.95),
    Gate("hard_negative_violations_0", "hn_violations", "=", 0),
    Gate("latency_150ms", "avg_latency_ms", "<", 150),
)
GATES_DOCUMENT = (
    Gate("LAW >= 95%", "law_rate", ">=", 0.95),
    Gate("DOC >= 85%", "doc_rate", ">=", 0.85),
    Gate("EVIDENCE >= 85%", "evidence_rate", ">=", 0.85),
    Gate("Latency < 250 ms", "avg_latency_ms", "<", 250),
)
GATES_GRAPH = (
    Gate("PRIMARY_PASS >= 80%", "primary_rate", ">=", 0.80),
    Gate("GRAPH_PATH_PASS >= 70%", "path_rate", ">=", 0.70),
    Gate("SUPPORT_PASS >= 60%", "support_rate", ">=", 0.60),
    Gate("Latency < 500 ms", "avg_latency_ms", "<", 500),
)
GATES_FINANCE = (
    Gate("TABLE_EVIDENCE_RATE", "table_evidence_rate", ">=", 0.90),
    Gate("CALC_TRACE_OK", "calc_trace_rate", ">=", 0.85, False),
    Gate("NUMERIC_ACCURACY", "numeric_accuracy", ">=", 0.95),
    Gate("CITATION_COVERAGE", "citation_coverage", ">=", 0.85),
    Gate("ABSTAIN_CORRECT", "abstain_correct", ">=", 0.90),
)
STATUTE_MISMATCH = ("kunnan", "kunta", "kuntakonserni", "kuntalaki", "kuntalain")
EXCEPTION_PHRASES = ("poiketen", "poikkeuksena", "jollei", "ellei", "jos ei", "sen estämättä", "siitä huolimatta", "ilman rajoitusta", "lukuun ottamatta")
DEFINITION_PHRASES = ("tarkoitetaan", "tässä laissa", "tässä luvussa", "käsitteellä", "määritelmä")
STATUTE_NUMBERS = {
    "kirjanpitolaki": "1336/1997", "kirjanpitolakia": "1336/1997", "kirjanpitolain": "1336/1997",
    "tilintarkastuslaki": "1141/2015", "tilintarkastuslakia": "1141/2015", "tilintarkastuslain": "1141/2015",
    "osakeyhtiölaki": "624/2006", "osakeyhtiölakia": "624/2006", "osakeyhtiölain": "624/2006",
    "hankintalaki": "1397/2016", "hankintalakia": "1397/2016", "hankintalain": "1397/2016",
}
ABSTAIN_STRONG = ("tänään", "2024", "2025", "helsinki", "helsingin", "tampere", "tampereen", "oulu", "oulun", "henkilökohtai", "osinko", "veroprosentti")
ABSTAIN_INTERPRET = ("konkurssi", "voimassa oleva", "uusi.*muutos")
ABSTAIN_FINANCE = (
    "2024", "2025", "tampere", "seinäjoki", "helsinki", "oulun", "veroprosentti", "asukasluku", "palkka", "ennuste", "suositus",
    "q1", "q2", "q3", "q4", "kvartaali", "osinko", "osinkoja", "velkaantumisaste", "anna suositus",
    "vuosikate-%", "omavaraisuusaste", "yhteissumma", "ylittävät", "lainojen osuus",
)
# End of the fixed values.

PROFILES = {
    "plain": Profile(),
    "crosslaw": Profile(router_bonus=0.02, guards=STATUTE_GUARDS, diversity_gap=0.02),
    "routed": Profile(router_bonus=0.02, guards=STATUTE_GUARDS_12),
    "answers": Profile(router_bonus=0.02, guards=STATUTE_GUARDS_12, limit=5),
    "autofill": Profile(router_bonus=0.02, guards=STATUTE_GUARDS_14),
    "graph": Profile(router_bonus=0.02, threshold_after=True, mismatch_penalty=0.03, mismatch_terms=STATUTE_MISMATCH),
    "grapheval": Profile(router_bonus=0.02, threshold_after=True, mismatch_penalty=0.03, mismatch_terms=STATUTE_MISMATCH),
    "adversarial": Profile(min_score=0.4),  # unrouted: search.fan_out, then search.context_boost
}

#: Rules of our own over the languages of the driver's tables.
LANGUAGES = Router(
    priors={"en": 0.4, "de": 0.25, "fr": 0.2, "es": 0.15},
    keywords={"en": ("the", "tion", "her", "ing"), "de": ("sch", "ung", "lich"), "fr": ("eau", "oui", "tre"), "es": ("ción", "que", "los")},
    core="en",
    anchors=("thing", "with", "that the"),
    explicit=(("keit", "de"), ("ç", "fr"), ("ñ", "es")),
    numbers=(("44/1066", "en"),),
)
LANGUAGE_PROFILE = Profile(min_score=0.05, router_bonus=0.02, guards=(("the", "en", 0.03), ("the", "de", -0.03), ("eau", "fr", 0.02), ("ción", "es", 0.02)), diversity_gap=0.02)
LANGUAGE_BOOSTS = Boosts(
    boosts=((("the", "her"), "1", None, 0.15), (("tion",), "2", "0", 0.10), (("ing", "eau"), "3", None, 0.08)),
    penalties=((("with",), "1", -0.10), (("her", "und"), "4", -0.05)),
    overlap_terms=("the", "that", "la", "der"),
    overlap_sections=("0", "1", "2", "5"),
)
