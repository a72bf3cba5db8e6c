"""URL filter by association rules.

Lists of (host, path) rules come first; the longest that fits decides. Pages
that a list decides are the labelled examples: Spark's FP-growth mines the
combinations of URL tokens that occur with a label, rules are pruned by
support and confidence, whatever their length, and pages that no list decides
get the verdict of the best rule whose tokens they hold, found through an
inverted index from a rule's rarest tokens. Without a rule the verdict is
"allow".

Tokens that occur in the same examples (a site's template) would make every
subset of theirs a rule; they are one item of the mining, a class of which any
token will do. A class that all examples hold adds nothing to a rule and
is one only by itself. Both follow from the redundancy rule, so no rule is lost.

What reaches the driver doesn't grow with the input: a token or set must be in
``MIN_SUPPORT`` of the examples, so for t tokens an example there are at most
t / MIN_SUPPORT such tokens and, for t' classes an example, 2^t' / MIN_SUPPORT sets.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

LISTS = {"block": ("net/", "example.com/de/"), "allow": ("example.net/en/", "org/fr/")}
MIN_SUPPORT = 0.02
MIN_CONFIDENCE = 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LABEL = "label="


def _lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def _rest(url: Column) -> Column:
    """What follows the first "://"; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def list_rule(host: Column, path: Column, lists: dict[str, tuple[str, ...]] = LISTS) -> Column:
    """The longest list rule that fits, else NULL."""
    found = F.lit(None).cast("string")
    for rule in sorted((r for rs in lists.values() for r in rs), key=lambda r: (len(r), r)):
        h, p = rule[: rule.index("/")], rule[rule.index("/") :]
        found = F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.lit(rule)).otherwise(found)
    return found


def list_verdict(rule: Column, lists: dict[str, tuple[str, ...]] = LISTS) -> Column:
    out = F.lit(None).cast("string")
    for verdict, rules in lists.items():
        out = F.when(rule.isin(*rules), F.lit(verdict)).otherwise(out)
    return out


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL: scheme s:, host labels h:, path segments p:
    and query keys q:, ASCII lower-cased, each run of digits as "#"."""
    shape = lambda c: F.regexp_replace(_lower(c), "[0-9]+", "#")
    tagged = lambda tag, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(shape(query), "&"), lambda x: F.split(x, "=")[0])
    scheme = F.when(F.instr(url, "://") > 0, F.substring_index(shape(url), "://", 1)).otherwise(F.lit(""))
    return F.coalesce(F.array_distinct(F.concat(
        tagged("s:", F.array(scheme)), tagged("h:", F.split(shape(host_of(url)), r"\.")), tagged("p:", F.split(shape(path_of(url)), "/")), tagged("q:", keys))),
        F.array().cast("array<string>"))


Rule = tuple[tuple[tuple[str, ...], ...], str, float, float]  # classes of tokens, label, confidence, support


def token_classes(examples: DataFrame, least: int) -> dict[tuple[str, ...], int]:
    """Frequent tokens, those of the same examples together -> number of
    examples. Sets of examples are compared by their size and two 64-bit hashes."""
    rows = examples.select("tokens", F.monotonically_increasing_id().alias("n"))
    held = rows.select(F.explode("tokens").alias("t"), F.xxhash64("n").alias("a"), F.xxhash64("n", F.lit("b")).alias("b"))
    sets = held.groupBy("t").agg(F.count("*").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")).where(F.col("n") >= least)
    return {tuple(sorted(r["tokens"])): r["n"] for r in sets.groupBy("n", "a", "b").agg(F.collect_list("t").alias("tokens")).collect()}


def mine(examples: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> list[Rule]:
    """examples(tokens, label) -> rules by confidence, then support (best
    first): a rule holds for what has a token of each of its classes. Rules
    that a rule of fewer of the classes makes needless (as sure, same label) are dropped."""
    per_label = {r["label"]: r["count"] for r in examples.groupBy("label").count().collect()}
    n = sum(per_label.values())
    if not n:
        return []
    classes = token_classes(examples, math.ceil(min_support * n))
    rules: list[Rule] = [((c,), label, k / n, k / n) for c, held in classes.items() if held == n for label, k in per_label.items() if k / n >= min_confidence and k >= math.ceil(min_support * n)]
    telling = sorted(c for c, held in classes.items() if held < n)
    if telling:
        number = F.create_map(*(F.lit(x) for i, c in enumerate(telling) for t in c for x in (t, str(i))))
        held = F.array_distinct(F.filter(F.transform("tokens", lambda t: F.try_element_at(number, t)), lambda i: i.isNotNull()))
        items = examples.select(F.array_append(held, F.concat(F.lit(_LABEL), "label")).alias("items"))
        model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
        found = model.associationRules.where(F.col("consequent")[0].startswith(_LABEL)).select("antecedent", F.col("consequent")[0].alias("c"), "confidence", "support").collect()
        rules += [(tuple(sorted(telling[int(i)] for i in r["antecedent"])), r["c"][len(_LABEL):], r["confidence"], r["support"]) for r in found]
    kept: dict[tuple, float] = {}
    needed = []
    for rule in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        a, label, sure, _ = rule
        smaller = (s for k in range(1, len(a)) for s in itertools.combinations(a, k))
        if not any(kept.get((s, label), 0) >= sure for s in smaller):
            kept[a, label] = sure
            needed.append(rule)
    return sorted(needed, key=_place)


def _place(rule: Rule) -> tuple:
    return -rule[2], -rule[3], rule[1] != "block", rule[0]


def inverted_index(rules: list[Rule]) -> dict[str, list[Rule]]:
    """token -> rules of whose rarest class (the one in fewest rules) it is."""
    in_rules = Counter(c for a, *_ in rules for c in a)
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        for t in min(rule[0], key=lambda c: (in_rules[c], len(c), c)):
            index.setdefault(t, []).append(rule)
    return index


def best_rule(tokens: list[str], index: dict[str, list[Rule]]) -> tuple[str | None, str | None]:
    """(label, tokens) of the best rule that the tokens hold; of equal rules the
    one with the first tokens (of a class, the first that is held)."""
    have, best = set(tokens), None
    for rule in {id(r): r for t in tokens for r in index.get(t, ())}.values():
        if best is not None and _place(rule)[:3] > best[0]:
            continue
        held = [next((t for t in c if t in have), None) for c in rule[0]]
        if None not in held:
            found = (_place(rule)[:3], sorted(held), rule[1])
            best = found if best is None else min(best, found)
    return (best[2], " ".join(best[1])) if best else (None, None)


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, mined): one row for each row of
    pages; mined names the tokens of the association rule that decided, if one
    did. A NULL url or one without "://" has empty host and path; NULL ids and
    repeated rows are rows like any other; an empty table gives an empty
    result; other columns are not read."""
    url = F.col("url")
    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    parsed = slim.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(url).alias("tokens"))
    ruled = parsed.withColumn("rule", list_rule(F.col("host"), F.col("path")))
    index = inverted_index(mine(ruled.where("rule IS NOT NULL").select("tokens", list_verdict(F.col("rule")).alias("label"))))

    def run(batches):
        for b in batches:
            got = [best_rule(t, index) for t in b.column("tokens").to_pylist()]
            cols = [b.column(n) for n in ("page_id", "host", "path", "rule")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([x for x, _ in got], pa.string()), pa.array([y for _, y in got], pa.string())], ["page_id", "host", "path", "rule", "label", "mined"])

    judged = arrow_map(ruled, run, "page_id long, host string, path string, rule string, label string, mined string")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce(list_verdict(F.col("rule")), "label", F.lit("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("mined")).alias("mined"))
