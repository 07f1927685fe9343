"""Vocabularies: ordered groups of terms. The order counts, and every list is a parameter."""

from __future__ import annotations

from dataclasses import dataclass, field

from lodestream.functions import patterns


# fmt: off
# The default vocabularies, in their order.
TARGETS = {
    "acetaminophen": (
        "acetaminophen", "acetominophen", "acetaminaphen", "tylenol", "paracetamol", "apap", "panadol",
    ),
    "ibuprofen": (
        "ibuprofen", "ibuprophen", "ibufrofen", "ibufrofin", "advil", "motrin", "nurofen", "brufen",
    ),
}
OTHERS = {
    "aspirin": (
        "aspirin", "acetylsalicylic acid", "asa", "bayer", "bufferin", "ecotrin", "anacin", "vazalore", "durlaza", "excedrin", "alka-seltzer",
        "alka seltzer", "bc powder", "asprin", "aspirine",
    ),
    "naproxen": (
        "naproxen", "naproxen sodium", "aleve", "anaprox", "naprosyn", "naprelan", "vimovo", "treximet", "flanax", "naproxin", "naproxene",
        "neproxen",
    ),
    "diclofenac": (
        "diclofenac", "diclofenac sodium", "diclofenac potassium", "voltaren", "voltarol", "cataflam", "cambia", "flector", "pennsaid",
        "zorvolex", "zipsor", "arthrotec", "dicloflenac", "declofenac", "diclofinac", "diklofenac",
    ),
    "ketoprofen": (
        "ketoprofen", "orudis", "oruvail", "ketum",
    ),
    "meloxicam": (
        "meloxicam", "mobic", "vivlodex", "qmiiz", "anjeso",
    ),
    "celecoxib": (
        "celecoxib", "celebrex", "elyxyb", "celekoxib", "celebrax",
    ),
    "diphenhydramine": (
        "diphenhydramine", "diphenhydramine hydrochloride", "diphenhydramine citrate", "benadryl", "zzzquil", "unisom", "nytol", "sominex",
        "simply sleep", "tylenol pm", "advil pm", "aleve pm", "benedryl", "bendryl", "bendadryl", "benadril", "dyphenhydramine",
        "dipenhydramine",
    ),
    "codeine": (
        "codeine", "codeine phosphate", "co-codamol", "co codamol", "cocodamol", "tylenol with codeine", "tylenol 3", "tylenol #3",
        "robitussin ac", "virtussin ac", "cheratussin ac", "tuzistra xr", "solpadeine", "panadeine", "codine", "codein", "codiene",
    ),
    "tramadol": (
        "tramadol", "ultram", "ultracet", "conzip", "qdolo", "tramal", "tramodol", "tramadal", "tramadrol", "tramdol", "trammadol",
    ),
    "cough_cold_medicine": (
        "cough syrup", "cough syrups", "cough medicine", "cough medicines", "cough suppressant", "cough suppressants", "dextromethorphan",
        "dxm", "guaifenesin", "guaiphenesin", "benzonatate", "tessalon", "delsym", "robitussin", "mucinex", "musinex", "nyquil", "dayquil",
        "benylin", "tussin", "buckley's", "buckleys", "bromfed", "dimetapp", "theraflu", "neocitran", "neocitron",
    ),
}
DOSING = (
    "can I take", "can I take more", "take another", "another dose", "how much", "how many", "too much", "overdose", "accidentally took",
    "took too many", "last dose", "next dose", "wait", "hours ago", "24 hours", "same day", "mg", "tablet", "caplet", "pill", "dose", "dosage",
    "every 4 hours", "every 6 hours", "every 8 hours", "every 12 hours", "mixed with", "combine", "safe to take",
)
EXCLUDED = (
    "dog", "cat", "pet", "baby", "infant", "toddler", "child", "kid", "pregnant", "pregnancy", "coupon", "sale", "ad", "commercial", "news",
    "lawsuit", "stock", "meme", "joke", "recreational", "trip", "getting high",
)
# fmt: on


@dataclass(frozen=True)
class Vocabulary:
    """What the text operators look for; every field can be replaced."""

    targets: dict = field(default_factory=lambda: dict(TARGETS))
    others: dict = field(default_factory=lambda: dict(OTHERS))
    dosing: tuple = DOSING
    excluded: tuple = EXCLUDED

    def target_patterns(self) -> dict[str, str]:
        return {name: patterns.words(terms) for name, terms in self.targets.items()}

    def other_patterns(self) -> dict[str, str]:
        return {name: patterns.words(terms) for name, terms in self.others.items()}


def load(path: str) -> Vocabulary:
    """A vocabulary from a YAML file with any of the keys ``medicine_terms``, ``other_medicine_terms``,
    ``dosing_terms`` and ``exclude_terms``; what is missing keeps its default."""
    import yaml

    with open(path, encoding="utf-8") as f:
        raw = yaml.safe_load(f) or {}
    groups = lambda key, default: {n: tuple(t) for n, t in raw[key].items()} if raw.get(key) else dict(default)
    terms = lambda key, default: tuple(raw[key]) if raw.get(key) is not None else default
    return Vocabulary(groups("medicine_terms", TARGETS), groups("other_medicine_terms", OTHERS), terms("dosing_terms", DOSING), terms("exclude_terms", EXCLUDED))


def frame(spark, groups: dict[str, tuple[str, ...]]):
    """(group, group_ord, term, term_ord): a vocabulary as a table."""
    rows = [(g, i, t, j) for i, (g, terms) in enumerate(groups.items()) for j, t in enumerate(terms)]
    return spark.createDataFrame(rows, "group string, group_ord int, term string, term_ord int")
