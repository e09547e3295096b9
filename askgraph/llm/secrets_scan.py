"""Secret scans with multipart credential linking, in Spark's own functions.

Strong patterns report on their own. Weak parts (an account name, a random
looking string, an endpoint) are common in clean text, and mean a credential
only together: an identifier with a secret, or a secret with an endpoint, within
a scope of characters. Parts of a text are joined as intervals: each lies in
bins of scope size, and complementary parts in the same or neighbouring bins
meet by an equal key. Parts of one kind don't overlap, so a bin holds few of
them and the join stays in proportion to the parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askgraph.llm.common import row_key, staged
from askgraph.llm.spans import as_kind, listed, masked, matches, together

SCOPE = 200
#: Kinds in the order of the report; the first three are strong.
KINDS = ("assign", "access", "hex", "account", "random", "endpoint")
# The same matches as the plain forms, possessive and with their least lengths inside where that
# changes nothing, so that long runs cost no backtracking.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
ACCOUNT = (
    r"(?i)\b(?:user(?:name|_?id)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?)"
    r"[\"']?\x20{0,4}[:=]\x20{0,4}[\"']?[A-Za-z0-9@._-]{3,}+"
)
RANDOM = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}+={0,2}+(?![A-Za-z0-9+/_=-])"
ENDPOINT = r"(?i)\b(?:https?|ftp|ssh|jdbc:[a-z]+|[a-z]+sql|mongodb|redis|amqp)://[^\x20\x09-\x0D\"'<>]{4,}+"
MASK = "[secret]"


def _looks_random(span: Column) -> Column:
    value = span["value"]
    return value.rlike("[0-9].*[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")


def _value_length(span: Column) -> Column:
    return F.length(F.regexp_extract(span["value"], ASSIGN, 2)) >= 12


def _part(spans: Column, role: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"),
            F.lit(role).alias("role"),
        ),
    )


def _spans(text: Column) -> list[Column]:
    """Spans of each kind in the order of KINDS."""
    assign = as_kind(matches(text, ASSIGN), "assign", 0, _value_length)
    access = as_kind(matches(text, ACCESS), "access", 1)
    hexes = as_kind(matches(text, HEX), "hex", 2)
    account = as_kind(matches(text, ACCOUNT), "account", 3)
    random = as_kind(matches(text, RANDOM), "random", 4, _looks_random)
    endpoint = as_kind(matches(text, ENDPOINT), "endpoint", 5)
    return [assign, access, hexes, account, random, endpoint]


def _linked(rows: DataFrame, scope: int) -> DataFrame:
    """Weak spans with a complementary part within the scope, a row per key."""
    identifiers = F.concat(_part(F.col("access"), "id"), _part(F.col("account"), "id"))
    secrets = F.concat(
        _part(F.col("assign"), "secret"), _part(F.col("hex"), "secret"), _part(F.col("random"), "secret")
    )
    parts = (
        rows.where(
            (F.size("account") + F.size("random") + F.size("endpoint") > 0)
            & (F.size("assign") + F.size("hex") + F.size("random") > 0)
            & (F.size("access") + F.size("account") + F.size("endpoint") > 0)
        )
        .select(
            "_k1",
            "_k2",
            F.explode(
                F.concat(identifiers, secrets, _part(F.col("endpoint"), "endpoint"))
            ).alias("p"),
        )
        .select("_k1", "_k2", "p.*")
        .distinct()
    )
    first, last = F.floor(F.col("start") / scope), F.floor(F.col("stop") / scope)
    secret = parts.where("role = 'secret'").withColumn(
        "bin", F.explode(F.sequence(first - 1, last + 1))
    )
    other = parts.where("role <> 'secret'").withColumn("bin", F.explode(F.sequence(first, last)))
    near = (F.col("o.start") - F.col("s.stop") <= scope) & (
        F.col("s.start") - F.col("o.stop") <= scope
    )
    # a part is not its own complement, as where a random string is an endpoint's path
    apart = (F.col("o.start") >= F.col("s.stop")) | (F.col("s.start") >= F.col("o.stop"))
    key = [F.col(f"s.{c}") == F.col(f"o.{c}") for c in ("_k1", "_k2", "bin")]
    met = secret.alias("s").join(other.alias("o"), [*key, near & apart])
    pairs = met.select(
        F.col("s._k1").alias("_k1"),
        F.col("s._k2").alias("_k2"),
        F.explode(
            F.array(
                *(
                    F.struct(*(F.col(f"{side}.{c}").alias(c) for c in ("start", "stop", "kind")))
                    for side in ("s", "o")
                )
            )
        ).alias("p"),
    ).select("_k1", "_k2", "p.*")
    weak = pairs.where(F.col("kind").isin(*KINDS[3:])).distinct()
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")) - 1
    return weak.groupBy("_k1", "_k2").agg(
        F.collect_list(
            F.struct(
                F.col("start"), rank.cast("int").alias("rank"), F.col("stop"), F.col("kind")
            )
        ).alias("linked")
    )


def _scanned(rows: DataFrame, scope: int) -> DataFrame:
    """Add the array columns ``base`` and ``linked`` to rows with a ``text``.

    Parts meet by a key of the whole row, so that copies of a text with ids of
    their own are spread.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = rows.select(*(c for c in rows.columns if c != "text"), *row_key(*rows.columns), text.alias("_t"))
    spans = [s.alias(k) for s, k in zip(_spans(F.col("_t")), KINDS, strict=True)]
    found = staged(
        rows.sparkSession, found.select("*", *spans).drop("_t"), "parts"
    )
    linked = _linked(found, scope).select(
        F.col("_k1").alias("_l1"), F.col("_k2").alias("_l2"), "linked"
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,stop:bigint,kind:string>>")
    return found.join(
        linked, (F.col("_k1") == F.col("_l1")) & (F.col("_k2") == F.col("_l2")), "left"
    ).select(
        "*", together(["assign", "access", "hex"]).alias("base"), F.coalesce("linked", none).alias("weak")
    )


def scan_secrets(
    docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Secrets of each document: counts and places of strong kinds, and all spans.

    Returns doc_id, n_assign, n_access, n_hex, base_sha256 (of the strong spans
    as kind:start:end by start, then kind, comma-joined; positions in code
    points, end exclusive) and spans (strong ones and linked weak ones, joined
    likewise).

    A null text counts as empty. Null and repeated doc_ids are rows like others.
    Spans of different kinds may overlap. An empty table gives no rows. Other
    columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = _scanned(rows, scope)
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "weak")).alias("spans"),
    )


def mask_secrets(docs: DataFrame, scope: int = SCOPE, text_col: str = "text") -> DataFrame:
    """``docs`` with every reported span in the text replaced by a mark.

    Texts without a span, null ones included, stay as they are; all columns and
    rows are kept.
    """
    texts = docs.select(F.col(text_col).alias("text")).where(F.col(text_col).isNotNull())
    found = _scanned(texts, scope).where(F.size("base") + F.size("weak") > 0)
    hits = found.groupBy(F.col("_k1").alias("_h1"), F.col("_k2").alias("_h2")).agg(
        F.first(F.concat("base", "weak")).alias("_spans")
    )
    keyed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
        F.col(text_col).alias("_text"),
        *row_key(text_col),
    )
    joined = keyed.join(
        hits, (F.col("_k1") == F.col("_h1")) & (F.col("_k2") == F.col("_h2")), "left"
    )
    text = F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(
        masked(F.col("_text"), F.col("_spans"), MASK)
    )
    return joined.select(
        *((text if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns)
    )
