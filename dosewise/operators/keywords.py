"""TX1 include/exclude keyword classifier over two text columns.

Both term lists compile to one case-insensitive regex alternation each
(a chain of 200+ LIKE predicates would exceed the codegen method limit).
Brace-enclosed annotations are removed first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the legacy wellness classifier's term lists ------------
INCLUDE_TERMS = [
    "adenovirus", "dpv", "hcpp", "lvk", "cvk", "dapp", "da2", "felv", "dhp", "dhl", "fvr", "fip ",
    "fiv", "fcv", "nobivac", "duramune", "galaxy", "fevaxyn", "felocell", "continuum", "fel-o-vax",
    "felovax", "solo-jec", "solojec", "progard", "rabdomun", "imrab", "eclipse", "univac", "vanguard",
    "recombitek", "calicivirus ", "chlamydiosis ", "coronavirus ", "distemper", "distemper combos",
    "feline immunodeficiency virus", "feline infectious peritonitis(fip)", "feline viral rhinotracheitis ",
    "hepatitis", "leptospirosis ", "leukemia", "lyme", "panleukopenia(feline distemper)", "parainfluenza ",
    "parvovirus", "rabies", "Primemune", "Calicivax", "Fel-O-Guard", "FelOGuard", "Fel O Guard",
    "Fel O Vax", "Bronchi-Shield", "BronchiShield", "Leptovax", "Naramune", "Solo Jec", "Rabvac",
    "Spectra", "Focus Cat Vax", "Focus Cat Vac", "ImunoVax", "Imuno-Vax", "Immuno Vac", "ImmunoVac",
    "Imuno-Vac", "Crotalus", "Purevax", "Oncept", "Neopar", "Leukocell", "Lymevax", "Bronchicine",
    "Neovac", "FRV", "CCR", "FCCR", "HCRP", "FRCP", "FCRV", "CVR", "HCP",
]
EXCLUDE_TERMS = [
    "other product", "sulfur", "ivd", "feliway", "diffuser", "pheromone", "dot blot", "serology", "tape",
    "tag", "fnote", "recheck", "recomm", "rule out", "r/o", "r / o", "hold", "reaction", "credit",
    "reminder", "quarantine", "infection", "deduct", "dont use", "to lab", "overcharged", "follow up",
    "note", "O gives", "Distal", "Ulna", "lipoma", "in due Aug", "temporary", "food", "Small Bites",
    "telephone", "laceration", "monitor", "called", "novartis", "declined", "deferred", "test", "screen",
    "exam", "antech", "cornell", "3dx", "4dx", "idexx", "neg", "pos", "wnl", "titer", "titre", "antigen",
    "antibody", "tray", "inventory", "dapper", "dapple", "chronic", "rhinoscopy", "cholangiohepatitis",
    "com:", "abaxis", "add - on", "alter", "anes", "baralyme", "bath", "bite check", "bite form",
    "bite release", "blood", "c6 lyme", "catheter", "cert", "cet", "chem", "cite", "consult", "crem",
    "d/d", "decline", "dehorn", "diagnostic", "dip", "drip", "duplicate", "dyp", "euth", "export", "favn",
    "five", "fluid", "gland", "head removal", "Health Care Plan", "Health Check Plus", "Health Chek Plus",
    "healthcare", "HealthChek Plus", "hills", "hill's", "hosp", "hydro", "hypo", "idx", "ifa", "igg", "in house",
    "inhouse", "In-House", "ivet", "lab", "Lyme C6", "Multiplex", "observ", "overhead", "polymend",
    "polymer", "pseudo", "purina", "quant", "rabies bite", "renal", "sedat", "send out", "snap", "soap",
    "solva", "sonic", "specimen", "spray", "suture", "treatment", "urine", "venison", "western",
]
BRACES = r"\{.*\}"


_META = set(".^$*+?()[]{}|\\/")


def _esc(term: str) -> str:
    """Escape regex metacharacters only (valid in Java and RE2 alike)."""
    return "".join("\\" + ch if ch in _META else ch for ch in term)


def alternation(terms) -> str:
    return "(?:" + "|".join(_esc(t.lower()) for t in terms) + ")"


def trie_regex(terms) -> str:
    """The same language as ``alternation(terms)``, written as a prefix
    trie: ``(?:fe(?:lv|l-o-vax)|...)``. A backtracking engine then tests
    one branch per character instead of every term at every position."""
    trie: dict = {}
    for term in {t.lower() for t in terms}:
        node = trie
        for ch in term:
            node = node.setdefault(ch, {})
        node[""] = {}  # end of a term

    def emit(node: dict) -> str:
        ends = "" in node
        branches = [_esc(ch) + emit(child) for ch, child in sorted(node.items()) if ch != ""]
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
        if ends:  # a term ends here; longer terms may continue
            return "(?:" + body + ")?"
        return body

    return "(?:" + emit(trie) + ")"


def strip_braces(c: Column) -> Column:
    """Texts without a brace, nearly all, are not rewritten."""
    return F.when(F.contains(c, F.lit("{")), F.regexp_replace(c, BRACES, "")).otherwise(c)


def clean_text(c: Column) -> Column:
    """Lower-cased text without brace annotations (compute once per row)."""
    return F.lower(strip_braces(c))


def matches_clean(clean: Column, terms) -> Column:
    return clean.rlike(trie_regex(terms))


def keyword_classify(handle: Column, descr: Column, include=INCLUDE_TERMS, exclude=EXCLUDE_TERMS,
                     cleaned: bool = False) -> Column:
    """True when either text holds an include term and neither holds an
    exclude term (NULL texts: a NULL side neither includes nor excludes).
    With ``cleaned=True`` the inputs are already ``clean_text`` columns."""
    h = handle if cleaned else clean_text(handle)
    d = descr if cleaned else clean_text(descr)
    inc = F.coalesce(matches_clean(h, include), F.lit(False)) | F.coalesce(matches_clean(d, include), F.lit(False))
    exc = F.coalesce(matches_clean(h, exclude), F.lit(False)) | F.coalesce(matches_clean(d, exclude), F.lit(False))
    return inc & ~exc
