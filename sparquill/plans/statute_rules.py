"""Rule data of the statutes beyond the router's: tags, anchors, mapping to reports, adversarial context and gates.

Statutes whose tags are not here are built with tables of their own, which operators.matching takes as data.
"""

from __future__ import annotations

from sparquill.plans.rules import Gate

# The first statute's tags by chapter title and by keyword.
MUNICIPAL_CHAPTER_TAGS = {
    "talous": ("talous", "budjetti", "rahoitus"),
    "talousarvio": ("talousarvio", "budjetti", "investoinnit"),
    "kirjanpito": ("kirjanpito", "tilinpäätös", "laskentatoimi"),
    "tarkastus": ("tarkastus", "tilintarkastus", "valvonta"),
    "hallinto": ("hallinto", "organisaatio", "johtaminen"),
    "päätöksenteko": ("päätöksenteko", "toimivalta", "delegointi"),
    "valtuusto": ("valtuusto", "demokratia", "päätöksenteko"),
    "kuntayhtymä": ("kuntayhtymä", "yhteistoiminta", "kuntaliitos"),
    "konserni": ("kuntakonserni", "tytäryhteisö", "omistajaohjaus"),
    "osallistuminen": ("osallistuminen", "vaikuttaminen", "demokratia"),
    "luottamushenkilö": ("luottamushenkilö", "valtuutettu", "palkkio"),
    "viranomainen": ("viranomainen", "viranhaltija", "henkilöstö"),
}
MUNICIPAL_KEYWORD_TAGS = {
    "alijäämä": ("alijäämä", "talousriski", "kriisikunta"),
    "ylijäämä": ("ylijäämä", "talous"),
    "laina": ("laina", "velka", "rahoitus"),
    "takaus": ("takaus", "vakuus", "rahoitus"),
    "investointi": ("investointi", "hanke", "talous"),
    "vero": ("vero", "verotus", "tulot"),
    "arviointimenettely": ("arviointimenettely", "kriisikunta", "valvonta", "kriteerit", "tunnusluvut", "raja-arvot"),
    "erityisen vaikea": ("kriisikunta", "arviointimenettely", "taloudellinen asema"),
    "tilinpäätös": ("tilinpäätös", "kirjanpito", "raportointi"),
    "tilintarkast": ("tilintarkastus", "tarkastus", "valvonta"),
    "konsernitilinpäätös": ("konsernitilinpäätös", "kuntakonserni", "raportointi"),
    "toimintakertomus": ("toimintakertomus", "raportointi", "tilinpäätös"),
    "hallintosääntö": ("hallintosääntö", "hallinto", "säännöt"),
    "kunnanjohtaja": ("kunnanjohtaja", "johtaminen", "viranhaltija"),
    "pormestari": ("pormestari", "johtaminen", "luottamushenkilö"),
    "kunnanhallitus": ("kunnanhallitus", "hallinto", "toimielin"),
    "lautakunta": ("lautakunta", "toimielin", "hallinto"),
    "esteellisyys": ("esteellisyys", "jääviys", "päätöksenteko"),
    "oikaisuvaatimus": ("oikaisuvaatimus", "muutoksenhaku", "valitus"),
    "kunnallisvalitus": ("kunnallisvalitus", "muutoksenhaku", "hallinto-oikeus"),
    "covid": ("korona", "koronaepidemia", "pandemia", "covid-19", "poikkeus", "epidemia"),
    "korona": ("korona", "koronaepidemia", "pandemia", "covid-19", "poikkeus", "epidemia"),
    "epidemia": ("korona", "koronaepidemia", "pandemia", "covid-19", "poikkeus", "epidemia"),
    "sisäinen valvonta": ("sisäinen valvonta", "riskienhallinta", "valvonta ja riskit", "kontrollitoiminnot"),
    "sisäisen valvonnan": ("sisäinen valvonta", "riskienhallinta", "valvonta ja riskit", "kontrollitoiminnot"),
    "riskienhallinta": ("riskienhallinta", "sisäinen valvonta", "riskien hallinta", "riskiarviointi"),
    "riskienhallinnan": ("riskienhallinta", "sisäinen valvonta", "riskien hallinta", "riskiarviointi"),
    "olennaiset": ("olennaiset tapahtumat", "merkittävät tapahtumat", "tärkeät tapahtumat"),
    "tunnusluku": ("tunnusluvut", "raja-arvot", "kriteerit", "kriisikunta"),
    "raja-arvo": ("raja-arvot", "tunnusluvut", "kriteerit", "kriisikunta"),
}
# Its anchors by section and moment.
MUNICIPAL_ANCHOR_TERMS = {
    ("115", "1"): ("sisäinen valvonta", "riskienhallinta", "tavoitteiden toteutuminen", "tuleva kehitys", "olennaiset asiat"),
    ("115", "2"): ("alijäämä", "alijäämän kattaminen", "kattamistoimenpiteet", "talouden tasapainottaminen", "tasapainotus"),
    ("115", "3"): ("tuloksen käsittely", "tuloskäsittelyesitys", "tilikauden tulos", "ylijäämän käyttö"),
    ("110", "default"): ("talousarvio", "taloussuunnitelma", "neljä vuotta"),
    ("110a", "default"): ("covid", "korona", "pandemia", "poikkeus", "epidemia"),
    ("113", "default"): ("tilinpäätös", "tilikausi", "kirjanpito"),
    ("114", "default"): ("konserni", "konsernitilinpäätös", "kuntakonserni", "tytäryhteisö"),
    ("62", "default"): ("eroaminen", "kuntayhtymästä eroaminen"),
    ("62a", "default"): ("yhdistyminen", "kuntayhtymien yhdistyminen"),
    ("62b", "default"): ("jakautuminen", "kuntayhtymän jakautuminen"),
    ("118", "1"): ("arviointimenettely", "valtiovarainministeriö"),
    ("118", "2"): ("alijäämän kattamatta jättäminen", "määräajan ylitys"),
    ("118", "3"): ("tunnuslukurajat", "konsernitunnusluvut", "raja-arvot"),
}
# Which sections of a report a statute's node maps to.
MAPPING_RULES = (
    ("kuntalaki_410_2015:113", ("tuloslaskelma", "tase", "rahoituslaskelma"), "GOVERNS"),
    ("kuntalaki_410_2015:114", ("konsernitilinpäätös", "konserni"), "GOVERNS"),
    ("kuntalaki_410_2015:115", ("toimintakertomus",), "REQUIRES_DISCLOSURE"),
    ("kuntalaki_410_2015:115:1", ("sisäinen_valvonta", "riskienhallinta"), "REQUIRES_DISCLOSURE"),
    ("kuntalaki_410_2015:118", ("talouden", "tunnusluvut", "vuosikate"), "RISK_FLAG"),
    ("kirjanpitolaki_1336_1997:3:2", ("liitetiedot",), "REQUIRES_DISCLOSURE"),
    ("tilintarkastuslaki_1141_2015", ("tilintarkastuskertomus", "tilintarkastaja"), "EVIDENCED_BY"),
)
# The terms of the adversarial context and the sources that it raises and lowers.
COMPANY_TERMS = ("osakeyhtiö", "hallituksen vastuu", "yhtiökokous", "toimitusjohtaja", "osakeyhtiölaki")
MUNICIPAL_TERMS = ("kunnan", "kuntakonserni", "kuntalaki", "valtuusto", "kunnanhallitus", "tarkastuslautakunta")
COMPANY_SOURCE, CORE_SOURCE = "osakeyhtiolaki_624_2006", "kuntalaki_410_2015"
ACCOUNTING_SOURCES = ("kirjanpitolaki_1336_1997", "kirjanpitoasetus_1339_1997")
# Gates of the adversarial evaluation.
GATES_ADVERSARIAL = (
    Gate("CONFUSION_FAIL_RATE", "confusion_rate", "<=", 0.02),
    Gate("HALLU_EVIDENCE", "hallucinated", "=", 0),
    Gate("VERSION_DRIFT", "drifted", "=", 0),
    Gate("ABSTAIN_CORRECT", "abstain_rate", ">=", 0.90),
)
# End of the fixed values.
