"""Secrets in texts, and parts of one credential linked across a scope.

DataFrame functions only. A text is scanned by regular expressions that give
matches and the pieces between them; running sums of both lengths are the
positions. Strong matches always count. Weak candidates (logins, short
passwords, key-like blobs, endpoints) are common in clean text, so one counts
only if the complementary parts of a credential lie in its scope. Candidates
meet the parts around them in an interval join: scopes and parts are cut into
bins as wide as the reach, parts are folded to one row per bin and role before
they meet, and the fold decides the overlap exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardlens.functions.scalar import quoted
from wardlens.session import durable

REACH = 200  # code points on either side of a weak candidate
_SEPARATOR = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = rf"(?i:password|passwd|secret|token|api_?key){_SEPARATOR}([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{12,}"  # 16 or more; a run has one
HEX = "[0-9a-f]{32,}"
LOGIN = rf"(?i:user_?name|user|login|client_?id|account_?id|access_?key_?id){_SEPARATOR}[A-Za-z0-9._@+-]{{3,}}"
ENDPOINT = r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\x00-\x20"'<>]+"""
ADDRESS = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?::[0-9]{1,5})?"
BLOB = "[A-Za-z0-9+/]{32,}"
WEAK = "|".join([ASSIGN, LOGIN, ENDPOINT, BLOB, ADDRESS])
STRONG = ["assign", "access", "hex"]
KINDS = [*STRONG, "login", "short", "blob", "endpoint"]  # order of spans with equal starts
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "login": "identifier", "short": "secret",
        "blob": "secret", "endpoint": "endpoint"}
NEEDS = {"login": ["secret"], "short": ["identifier"], "blob": ["identifier"], "endpoint": ["identifier", "secret"]}
_MATCH = "array<struct<gap:int,len:int,kind:string>>"


def _scan(text: Column, pattern: str, applies: Column, kind) -> Column:
    """Matches in order: length of the text before each since the last one, own length, kind or null."""
    def laid_out(parts: Column) -> Column:
        return F.transform(parts["m"], lambda m, i: F.struct(
            F.length(F.get(parts["p"], i)).cast("int").alias("gap"), F.length(m).cast("int").alias("len"),
            kind(m).alias("kind")))

    parts = F.array(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p")))
    return F.when(applies, F.transform(parts, laid_out)[0]).otherwise(F.lit(None)).cast(_MATCH)


def _weak_kind(match: Column) -> Column:
    value = F.regexp_extract(match, ASSIGN, 1)
    mixed = match.rlike("[a-z]") & match.rlike("[A-Z]") & match.rlike("[0-9]") & (F.length(match) <= 128)
    return (F.when(match.rlike(f"^{ASSIGN}$"), F.when(F.length(value) < 8, F.lit("short")))
            .when(match.rlike(f"^{LOGIN}$"), F.lit("login"))
            .when(match.rlike(f"^{ENDPOINT}$") | match.rlike(f"^{ADDRESS}$"), F.lit("endpoint"))
            .when(mixed & ~match.rlike(ACCESS) & ~match.rlike(HEX), F.lit("blob")))


def scanned(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row number, the key and the matches of four scans for every row; written, so row numbers stay.

    The scan for weak candidates runs where a text has both an identifier and
    a secret of any strength, for without them no candidate can count.
    """
    t = F.col("text")
    rows = docs.select(quoted(key).alias("id"), quoted(text).cast("string").alias("text"))
    seen = (rows.withColumn("is_assign", t.rlike(ASSIGN))
            .withColumn("is_access", t.contains("AKIA") & t.rlike(ACCESS)).withColumn("is_hex", t.rlike(HEX))
            .withColumn("is_linkable", (F.col("is_access") | t.rlike(LOGIN))
                        & (F.col("is_assign") | F.col("is_hex") | t.rlike(BLOB))))
    scans = [
        _scan(t, ASSIGN, F.col("is_assign"),
              lambda m: F.when(F.length(F.regexp_extract(m, ASSIGN, 1)) >= 8, F.lit("assign"))),
        _scan(t, ACCESS, F.col("is_access"), lambda m: F.lit("access")),
        _scan(t, HEX, F.col("is_hex"), lambda m: F.lit("hex")),
        _scan(t, WEAK, F.col("is_linkable"), _weak_kind)]
    return durable(seen.select(F.monotonically_increasing_id().alias("row"), "id", F.array(*scans).alias("scans")), "secret-scans")


def positions(scans: DataFrame) -> DataFrame:
    """``row``, ``kind``, ``start``, ``end`` of every match that has a kind; code points, end exclusive."""
    each = (scans.select("row", F.posexplode("scans").alias("scan", "found"))
            .select("row", "scan", F.posexplode("found").alias("i", "match")))
    before = Window.partitionBy("row", "scan").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("match.gap") + F.col("match.len")).cast("long")).over(before)
    return (each.withColumn("end", end).where("match.kind IS NOT NULL")
            .select("row", F.col("match.kind").alias("kind"), (F.col("end") - F.col("match.len")).alias("start"), "end"))


def _role(kind: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])[kind]


def linked(spans: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak spans in whose scope all the parts lie that they need.

    A scope reaches ``reach`` code points to either side. It covers two bins
    at least, so in its first bin only ends and in its last only starts can
    miss it: the least start and the greatest end of a role in a bin tell
    whether any part of that role there overlaps.
    """
    def bins(start: Column, end: Column) -> Column:
        return F.explode(F.sequence(F.floor(start / reach), F.floor((end - 1) / reach)))

    parts = (spans.where(_role(F.col("kind")) != "endpoint")
             .withColumn("bin", bins(F.col("start"), F.col("end")))
             .groupBy(F.col("row").alias("__row"), F.col("bin").alias("__bin"), _role(F.col("kind")).alias("role"))
             .agg(F.min("start").alias("least"), F.max("end").alias("greatest")))
    scopes = (spans.where(F.col("kind").isin(*NEEDS))
              .withColumn("bin", bins(F.greatest(F.col("start") - reach, F.lit(0)), F.col("end") + reach)))
    overlaps = ((F.col("row") == F.col("__row")) & (F.col("bin") == F.col("__bin"))
                & (F.col("least") < F.col("end") + reach) & (F.col("greatest") > F.col("start") - reach))
    met = (scopes.join(parts, overlaps).groupBy("row", "kind", "start", "end")
           .agg(F.bool_or(F.col("role") == "identifier").alias("identifier"),
                F.bool_or(F.col("role") == "secret").alias("secret")))
    complete = F.lit(False)
    for kind, needed in NEEDS.items():
        found = F.col("kind") == kind
        for role in needed:
            found = found & F.col(role)
        complete = complete | found
    return met.where(complete).select("row", "kind", "start", "end")


def spans(scans: DataFrame, reach: int = REACH) -> DataFrame:
    """All reported spans, one row each: the strong ones and the linked weak ones."""
    found = durable(positions(scans), "secret-spans")
    return found.where(F.col("kind").isin(*STRONG)).unionByName(linked(found, reach))


def report(docs: DataFrame, *, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """Per row its key, the number of strong spans of each kind, their digest, and all spans as text.

    Null and empty texts have none. Texts are scanned whole at any length, in
    time that grows with their matches, not with pairs of them. Repeated rows
    and rows without a key are reported each; an empty table gives no rows;
    other columns are ignored.
    """
    scans = scanned(docs, key, text)
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    one = F.struct("start", order.alias("order"), F.concat_ws(":", "kind", "start", "end").alias("span"))
    strong = F.col("order") <= len(STRONG)
    listed = (spans(scans, reach).withColumn("order", order).groupBy(F.col("row").alias("__row"))
              .agg(*[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in STRONG],
                   F.sort_array(F.collect_list(F.when(strong, one))).alias("strong"),
                   F.sort_array(F.collect_list(one)).alias("every")))

    def joined(column: str) -> Column:
        return F.coalesce(F.array_join(F.transform(F.col(column), lambda s: s["span"]), ","), F.lit(""))

    return (scans.select("row", "id").join(listed, F.col("row") == F.col("__row"), "left")
            .select(F.col("id").alias(key), *[F.coalesce(F.col(f"n_{k}"), F.lit(0)).cast("long").alias(f"n_{k}") for k in STRONG],
                    F.sha2(joined("strong").cast("binary"), 256).alias("base_sha256"), joined("every").alias("spans")))
