"""Fixed values and parameter profiles of the entity resolution pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Abbreviations of names and what they stand for.
NAME_ABBREVIATIONS = {
    "corp": "corporation", "pvt": "private", "ltd": "limited", "inc": "incorporated", "co": "company",
    "llc": "limited liability company", "llp": "limited liability partnership", "intl": "international",
    "mfg": "manufacturing", "svcs": "services", "assoc": "associates", "assocs": "associates", "bros": "brothers",
    "hldgs": "holdings", "grp": "group", "mgmt": "management", "svc": "service", "natl": "national",
    "indl": "industrial", "ind": "industries", "tech": "technology", "sys": "systems", "soln": "solutions",
    "solns": "solutions", "ent": "enterprises", "entp": "enterprises", "dept": "department",
}
# Abbreviations of addresses and what they stand for.
ADDRESS_ABBREVIATIONS = {
    "rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard", "dr": "drive", "ln": "lane",
    "hwy": "highway", "fl": "floor", "flr": "floor", "apt": "apartment", "ste": "suite", "bldg": "building",
    "no": "number", "nagar": "nagar",
}
# The abbreviations of the lite profile.
LITE_NAMES = ("corp", "pvt", "ltd", "inc", "co", "llc", "llp", "intl", "mfg", "svcs", "assoc", "bros", "grp", "mgmt", "tech", "sys")
LITE_ADDRESSES = ("rd", "st", "ave", "blvd", "dr", "ln", "hwy", "fl", "apt", "ste", "bldg")


@dataclass(frozen=True)
class Profile:
    """Parameters of one way to run the pipeline; see FULL and LITE."""

    names: dict[str, str] = field(default_factory=lambda: dict(NAME_ABBREVIATIONS))
    addresses: dict[str, str] = field(default_factory=lambda: dict(ADDRESS_ABBREVIATIONS))
    passes: tuple[str, ...] = ("A_exact", "B_char_tfidf", "C_token_tfidf", "D_postal", "E_phonetic", "F_minhash", "G_prefix")
    char_ngrams: tuple[int, int] = (2, 5)
    token_ngrams: tuple[int, int] = (1, 2)
    top_k: int = 50
    postal_cap: int = 500
    narrow_postal: bool = True
    phonetic_cap: int = 500
    prefix_length: int = 4
    prefix_cap: int = 500
    permutations: int = 128
    bands: int = 32
    shingle: int = 3
    candidate_cap: int = 500
    thresholds: tuple[float, float, float] = (0.05, 0.95, 0.01)
    train_share: float = 0.70
    validation_share: float = 0.15
    negatives_per_positive: int = 5
    seed: int = 42


FULL = Profile()
#: Fewer passes on training data, a lower prefix cap and a grid without its last threshold.
LITE = replace(
    FULL,
    names={k: NAME_ABBREVIATIONS[k] for k in LITE_NAMES},
    addresses={k: ADDRESS_ABBREVIATIONS[k] for k in LITE_ADDRESSES},
    passes=("A_exact", "B_char_tfidf", "C_token_tfidf", "D_postal", "G_prefix"),
    narrow_postal=False,
    prefix_cap=200,
    thresholds=(0.05, 0.94, 0.01),
)
