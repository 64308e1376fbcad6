"""Secrets in texts, with corpus-wide ownership of each candidate.

Three kinds are found by pattern and stay as they are. High-entropy tokens are
candidates too. Every candidate is hashed, and over the whole corpus the
distinct owners and repositories of each hash are counted: what many owners
hold is a widely copied example, what one or two hold looks like a live
credential of theirs. Candidate tokens that look live are reported as kind
``owned``; pattern matches are marked live or example by the same rule.

Hashes travel, not texts: each task first drops its own repeats of (hash, owner,
repository), so an example in a third of all documents is a few rows a task;
only widely held hashes are joined back, to narrow rows.

Null texts count as empty, null owners and repositories as one owner and one
repository each. Repeated rows count once for ownership and each get their row.
No rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytide.llm.spans import as_text, count_kind, in_order, located, only_if, outside, replaced
from skytide.session import stage

# Fixed patterns of the base kinds; \x22 and \x27 are the two quotes.
ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex")
OWNED = "owned"
# Bits a character: joined words of one case stay below LETTER_ENTROPY, that of letters in prose.
MIXED_ENTROPY = 3.5
LETTER_ENTROPY = 4.2
MAX_OWNERS = 2
MAX_REPOSITORIES = 4


def base_spans(text: Column) -> Column:
    assign = F.filter(located(text, ASSIGN, "assign", 0, 2), lambda s: F.length(s["value"]) >= 12)
    access = only_if(text.contains("AKIA"), located(text, ACCESS, "access", 1))
    return in_order(assign, access, located(text, HEX, "hex", 2))


def entropy(value: Column) -> Column:
    """Bits a character, of the value's own character frequencies."""
    n = F.length(value)
    of = lambda c: n - F.length(F.replace(value, c, F.lit("")))
    each = F.transform(F.array_distinct(F.split(value, "")), lambda c: of(c).cast("double"))
    return F.log2(n.cast("double")) - F.aggregate(each, F.lit(0.0), lambda acc, k: acc + k * F.log2(k)) / n


def candidate_tokens(text: Column) -> Column:
    """Long tokens that look random: by their entropy, by less of it where letters of
    both cases or digits and letters mix, or by many digits."""
    tokens = located(text, CANDIDATE, OWNED, 3)
    digits = lambda v: F.regexp_count(v, F.lit("[0-9]"))

    def random(s):
        v = s["value"]
        letters = v.rlike("[A-Za-z]")
        numeric = (digits(v) * 8 >= F.length(v)) & (digits(v) < F.length(v)) & letters
        mixed = (v.rlike("[0-9]") & letters) | (v.rlike("[a-z]") & v.rlike("[A-Z]"))
        return numeric | (entropy(v) >= F.when(mixed, MIXED_ENTROPY).otherwise(LETTER_ENTROPY))

    return F.filter(tokens, random)


def widely_held(found: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """Hashes with more owners or repositories than a credential of one owner would have."""
    held = (
        found.select(F.explode(F.array_distinct(F.concat(F.col("base.hash"), F.col("extra.hash")))).alias("hash"), "owner", "repository")
        .distinct()
        .groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
        .groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))
    )
    return held.where((F.col("owners") > max_owners) | (F.col("repositories") > max_repositories))


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | str = "source", repository: Column | str | None = None,
    max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example`` and
    ``found``: all spans with kind, positions and whether they look live."""
    owner = F.col(owner) if isinstance(owner, str) else owner
    repository = owner if repository is None else F.col(repository) if isinstance(repository, str) else repository
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashed = lambda spans: F.transform(
        spans,
        lambda s: F.struct(s["start"], s["kind_no"], s["end"], s["kind"], F.xxhash64(s["value"]).alias("hash")),
    )
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        base_spans(text).alias("base"), candidate_tokens(text).alias("extra"),
    )
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository",
        hashed(F.col("base")).alias("base"), hashed(outside(F.col("extra"), F.col("base"))).alias("extra"),
    )
    found = stage(rows, "candidates")
    wide = widely_held(found, max_owners, max_repositories).select("hash")
    each = found.select("row", F.explode(F.array_distinct(F.concat(F.col("base.hash"), F.col("extra.hash")))).alias("hash"))
    copied = each.join(wide, "hash").groupBy("row").agg(F.collect_set("hash").alias("copied"))
    known = F.coalesce(F.col("copied"), F.array().cast("array<bigint>"))
    live = lambda s: ~F.array_contains(known, s["hash"])
    spans = F.array_sort(F.concat("base", F.filter("extra", live)))
    base = as_text(F.col("base"))
    return found.join(copied, "row", "left").select(
        "doc_id", *[count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
        F.sha2(base, 256).alias("base_sha256"), as_text(spans).alias("spans"),
        F.size(F.filter(spans, live)).cast("bigint").alias("n_live"),
        F.size(F.filter(spans, lambda s: ~live(s))).cast("bigint").alias("n_example"),
        F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"], live(s).alias("live"))).alias("found"),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with each span of ``found`` replaced by its kind in brackets."""
    return replaced(text, spans, lambda s: F.concat(F.lit("["), s["kind"], F.lit("]")))
