"""Text units over the supplied free-text tables.

Bindings: the service lookup of the keyword classifier is ``documents``
(handle = language and source, descr = the whole text); personal-data
shapes are searched in whole document texts; recipient lists are built
from ``conversations`` (one project per conversation, one address per
turn); the tokeniser runs over whole ``benchmark`` and document texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..operators import contact as cl
from ..operators import keywords as kw
from ..operators import upsert as up
from ..sources.tables import Tables


def service_lookup(t: Tables) -> DataFrame:
    return t.documents.select(
        F.col("doc_id").alias("id"), (F.col("doc_id") % 25).alias("hid"),
        F.concat_ws(" ", F.col("lang"), F.col("source")).alias("handle"), F.col("text").alias("descr"))


def _hit(clean: str, terms) -> Column:
    """Whether a cleaned text holds a term; a NULL text holds none."""
    return F.coalesce(kw.matches_clean(F.col(clean), terms), F.lit(False))


def wellness_by_keywords(t: Tables, ctx: RunContext) -> DataFrame:
    """TX1: services classified as wellness by the include/exclude lists,
    counted per clinic with the number of texts screened."""
    s = service_lookup(t).select("hid", kw.clean_text(F.col("handle")).alias("h"), kw.clean_text(F.col("descr")).alias("d"))
    # each list passes a text once: the include hit is a column, used twice, and only its rows meet the exclude list
    s = s.select("hid", "h", "d", _hit("h", kw.INCLUDE_TERMS).alias("handle_hit"), _hit("d", kw.INCLUDE_TERMS).alias("descr_hit"))
    include = F.col("handle_hit") | F.col("descr_hit")
    s = s.select("hid", "descr_hit", F.when(include, ~(_hit("h", kw.EXCLUDE_TERMS) | _hit("d", kw.EXCLUDE_TERMS))).alias("is_wellness"))
    return s.groupBy("hid").agg(
        F.count(F.lit(1)).alias("services"),
        F.count(F.when(F.col("is_wellness"), 1)).alias("wellness_services"),
        F.count(F.when(F.col("descr_hit"), 1)).alias("include_hits"),
    )


def pii_shapes(t: Tables, ctx: RunContext) -> DataFrame:
    """PI1: texts with phone-like, card-like and long digit runs, per source."""
    d = t.documents
    return d.groupBy("source").agg(
        F.count(F.lit(1)).alias("docs"),
        F.count(F.when(cl.has_phone(F.col("text")), 1)).alias("with_phone"),
        F.count(F.when(cl.has_card(F.col("text")), 1)).alias("with_card"),
        F.count(F.when(cl.has_digit_run(F.col("text")), 1)).alias("with_digit_run"),
        F.count(F.when(cl.valid_email(F.regexp_extract(F.col("text"), r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,4}", 0)).isNotNull(), 1)).alias("with_email"),
    )


def recipient_lists(t: Tables, ctx: RunContext) -> DataFrame:
    """LA1: comma-separated active addresses per project, sorted."""
    c = t.conversations.select(
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("project"),
        F.concat(F.col("role"), F.lit("."), F.col("turn").cast("string"), F.lit("@example.com")).alias("email_addr"),
        F.when(F.col("turn") % 3 != 2, F.lit("Y")).otherwise(F.lit("N")).alias("active_ind"))
    return up.list_agg(c.where(F.col("active_ind") == "Y"), ["project"], "email_addr", name="email_list")


def token_profile(t: Tables, ctx: RunContext) -> DataFrame:
    """TK2: per text, the delimiter chosen and the tokens it yields."""
    texts = t.benchmark.select(F.lit("benchmark").alias("src"), F.col("item_id").alias("id"), "text").unionByName(
        t.documents.select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"), "text"))
    toks = up.tokenise(F.col("text"))
    x = texts.select("src", "id", up.detect_delimiter(F.col("text")).alias("delimiter"), toks.alias("tokens"))
    return x.select(
        "src", "id", F.coalesce(F.col("delimiter"), F.lit("none")).alias("delimiter"),
        F.size("tokens").cast("long").alias("n_tokens"),
        F.size(F.filter("tokens", lambda s: s.isNull())).cast("long").alias("n_empty"),
        F.coalesce(F.array_max(F.transform("tokens", lambda s: F.length(s))), F.lit(0)).cast("long").alias("max_token_len"),
        F.try_element_at("tokens", F.lit(1)).alias("first_token"),  # NULL where a text has no token
    )
