"""Personal data in texts, and the terms that give a person away.

Four kinds are found by pattern and stay as they are; their values are the
protected entities. Sanitisation by information content then looks at all words of
two letters or more of the documents that hold them: over the corpus, a term reveals
an entity by their pointwise mutual information, log2(c(t, e) N / (df(t) df(e))),
held against what there is to reveal, the entity's information content
log2(N / df(e)). Terms whose share reaches ``disclosure``, seen with the entity in
``support`` different texts or more, are reported as kind ``term`` wherever they
stand in a document that holds the entity; ``sanitised`` removes entities and
generalises terms.

N, df and c count documents; ``support`` counts different texts (by hash), so
copies alone are no evidence. Counts cover every text and are summed in each
task before the shuffle.

Null texts count as empty; texts of any length are searched whole. Repeated rows each get their row; ids may be null or
repeated. No rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytide.llm.spans import as_text, count_kind, in_order, located, only_if, outside, replaced
from skytide.session import broadcast_if_small, stage

# Fixed patterns of the base kinds. Groups repeat possessively where nothing
# follows them: same matches, no recursion on long runs. A run that cannot begin a
# match is not tried again from its middle, unless a match has just ended there.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
SUPPORT = 3
DISCLOSURE = 0.5
_WORD = r"\p{L}{2,}"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _ip_ok(value: Column) -> Column:
    """Each part at most 255, leading zeros allowed."""
    return F.forall(F.split(value, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3) & (F.coalesce(F.right(p, F.lit(3)).cast("int"), F.lit(0)) <= 255))


def _luhn(digits: Column) -> Column:
    reverse = F.reverse(digits)
    # from the right, every second digit doubled, less 9 above 9
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, k: acc
        + F.element_at(F.array(*[F.lit(v) for v in (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                       F.substring(reverse, k, F.lit(1)).cast("int") + 1 + F.when(k % 2 == 0, 10).otherwise(0)),
    )
    return total % 10 == 0


def base_spans(text: Column) -> Column:
    email = only_if(text.contains("@"), located(text, EMAIL, "email", 0))
    ip = F.filter(located(text, IP, "ip", 1), lambda s: _ip_ok(s["value"]))
    card = F.filter(located(text, CARD, "card", 2), lambda s: F.length(_digits(s["value"])).between(12, 19))
    card = F.filter(card, lambda s: _luhn(_digits(s["value"])))
    phone = only_if(text.contains("+"), located(text, PHONE, "phone", 3))
    phone = F.filter(phone, lambda s: F.length(_digits(s["value"])).between(9, 15))
    return in_order(email, ip, card, phone)


def _terms(text: Column, base: Column) -> Column:
    """Words outside all base spans, as spans with the hash of the lower-cased word."""
    words = outside(located(text, _WORD, TERM, 4), base)
    plain = lambda w: [w[c].alias(c) for c in ("start", "kind_no", "end", "kind")]
    return F.transform(words, lambda w: F.struct(*plain(w), F.xxhash64(F.lower(w["value"])).alias("term")))


def revealing_terms(found: DataFrame, texts: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """``text_hash, spans``: where terms stand that reveal an entity of the same text.

    Entities of fewer than ``support`` texts, and terms too frequent to reach the
    threshold even if they always stood with the entity, go before any pair is made.
    """
    n = F.lit(found.count())
    held = found.where(F.size("entities") > 0).groupBy("text_hash").agg(F.first("entities").alias("entities"), F.count(F.lit(1)).alias("copies"))
    each = stage(held.select("text_hash", "copies", F.explode("entities").alias("entity")), "entities")
    shared = each.groupBy("entity").agg(F.sum("copies").alias("df_e"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= support)
    each = stage(each.join(broadcast_if_small(stage(shared.drop("texts"), "shared-entities")), "entity"), "held-entities")

    told = texts.join(broadcast_if_small(each.select("text_hash").distinct()), "text_hash", "left_semi").dropDuplicates(["text_hash"])
    worded = stage(told.select("text_hash", _terms(F.col("text"), base_spans(F.col("text"))).alias("words")), "worded")
    distinct = stage(worded.select("text_hash", F.explode(F.array_distinct("words.term")).alias("term")), "terms")
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_WORD), 0))
    # counted before the join: its rows follow the vocabulary, not the terms' occurrences
    counted = texts.select(F.explode(words).alias("w")).groupBy(F.xxhash64("w").alias("term")).agg(F.count(F.lit(1)).alias("df_t"))
    df_t = broadcast_if_small(stage(counted.join(distinct.select("term").distinct(), "term"), "frequencies"))

    content = F.log2(n / F.col("df_e"))
    most = F.col("df_e") * F.pow(n / F.col("df_e"), F.lit(1 - disclosure)) * (1 + 1e-9)
    pairs = distinct.join(df_t, "term").join(each, "text_hash").where((F.col("df_t") <= most) & (content > 0))
    pairs = pairs.groupBy("entity", "term", "df_e", "df_t").agg(F.sum("copies").alias("c"), F.count(F.lit(1)).alias("texts"))
    mutual = F.log2(F.col("c") * n / (F.col("df_t") * F.col("df_e")))
    revealing = pairs.where((F.col("texts") >= support) & (mutual >= disclosure * content)).select("entity", "term")
    revealing = broadcast_if_small(stage(revealing, "revealing"))
    terms = each.join(revealing, "entity").groupBy("text_hash").agg(F.collect_set("term").alias("known"))
    plain = lambda w: F.struct(*[w[c].alias(c) for c in ("start", "kind_no", "end", "kind")])
    mine = F.transform(F.filter("words", lambda w: F.array_contains(F.col("known"), w["term"])), plain)
    return worded.join(terms, "text_hash").select("text_hash", mine.alias("terms"))


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, disclosure: float = DISCLOSURE
) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term`` and ``found``: all spans."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    rows = texts.select("doc_id", "text_hash", base_spans(F.col("text")).alias("held"))
    rows = rows.select(
        "doc_id", "text_hash",
        F.transform("held", lambda s: F.struct(s["start"], s["kind_no"], s["end"], s["kind"])).alias("base"),
        F.array_distinct(F.transform("held", lambda s: F.xxhash64(s["kind"], F.lower(s["value"])))).alias("entities"),
    )
    found = stage(rows, "personal")
    terms = broadcast_if_small(stage(revealing_terms(found, texts, support, disclosure), "told"))
    spans = F.array_sort(F.concat("base", F.coalesce("terms", F.array().cast("array<struct<start: int, kind_no: int, end: int, kind: string>>"))))
    return found.join(terms, "text_hash", "left").select(
        "doc_id", *[count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
        F.sha2(as_text(F.col("base")), 256).alias("base_sha256"), as_text(spans).alias("spans"),
        count_kind(spans, TERM).alias("n_term"), spans.alias("found"),
    )


def sanitised(text: Column, spans: Column) -> Column:
    """The text with entities removed and revealing terms generalised to ``[term]``."""
    return replaced(text, spans, lambda s: F.when(s["kind"] == TERM, F.lit("[term]")).otherwise(F.lit("")))
