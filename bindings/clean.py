"""Sources, cleaning and encoding bound to the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import sqltext as S
from bindings.encounters import encounters, raw_encounters, table
from wardlens.functions import codes
from wardlens.functions.scalar import (
    at_least, map_codes, quoted, range_label, round_half_even,
)
from wardlens.operators import encode, profile
from wardlens.operators.dedup import duplicate_count, first_per_key
from wardlens.operators.features import derive_features
from wardlens.operators.impute import MedianImputer
from wardlens.operators.order import ordered_index
from wardlens.operators.ranges import label_ranges
from wardlens.operators.split import feature_names
from wardlens.plans.prepare import (
    COMPAT, FULL, Prepare, code_columns, first_encounters, run_features, run_prepare,
    run_preprocess,
)
from wardlens.session import durable, scratch_path
from wardlens.sources.contract import contract_report
from wardlens.sources.encounters import OPTIONAL, REQUIRED, scan_encounters
from wardlens.sources.tables import read_stage, write_stage

SIZES = {"small": (1, 10), "medium": (15, 25), "large": (30, 45)}
PRIORITY = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}


def raw_csv(spark: SparkSession, sf_dir: str) -> str:
    """The raw view written out as the headed CSV a user would start from."""
    path = scratch_path(spark, "raw-csv")
    raw_encounters(spark, sf_dir).write.option("header", True).csv(path)
    return path


def q_scan_encounters(spark, sf_dir) -> DataFrame:
    return scan_encounters(spark, raw_csv(spark, sf_dir))


def firsts(spark, sf_dir) -> DataFrame:
    return first_encounters(encounters(spark, sf_dir))


def q_cleaned(spark, sf_dir) -> DataFrame:
    first = firsts(spark, sf_dir)
    return Prepare().fit(first).clean(first)


def q_featured(mode):
    def run(spark, sf_dir) -> DataFrame:
        first = firsts(spark, sf_dir)
        return Prepare(mode).fit(first).featured(first)
    return run


def q_scan_stage(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "featured")
    df = q_featured(FULL)(spark, sf_dir)
    write_stage(df, path)
    return read_stage(spark, path, df.schema)


def q_write_stage(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "cleaned-csv")
    df = q_cleaned(spark, sf_dir)
    write_stage(df, path, "csv")
    return read_stage(spark, path, df.schema, "csv")


def q_preprocess_from_csv(spark, sf_dir) -> DataFrame:
    return run_preprocess(spark, raw_csv(spark, sf_dir), scratch_path(spark, "cleaned"))


def q_features_from_stage(spark, sf_dir) -> DataFrame:
    cleaned = scratch_path(spark, "cleaned")
    write_stage(q_cleaned(spark, sf_dir), cleaned)
    return run_features(spark, cleaned, scratch_path(spark, "featured"))


def q_prepare_from_csv(spark, sf_dir) -> DataFrame:
    return run_prepare(spark, raw_csv(spark, sf_dir), scratch_path(spark, "featured"))


def q_contract(spark, sf_dir) -> DataFrame:
    """The contract of the raw view with how many values each column really holds."""
    df = encounters(spark, sf_dir)
    report = contract_report(df, REQUIRED, OPTIONAL)
    filled = profile.missing_profile(df).select("column", "nulls")
    return report.join(filled, "column", "left")


def q_dense_events(spark, sf_dir) -> DataFrame:
    return (ordered_index(table(spark, sf_dir, "events").select("event_id", "ts"),
                          ["ts", "event_id"], "position").select("event_id", "position"))


def q_dense_order(spark, sf_dir) -> DataFrame:
    kept = first_per_key(encounters(spark, sf_dir), ["patient_nbr"], ["encounter_id"])
    return (ordered_index(kept.select("encounter_id", "patient_nbr"), ["encounter_id"], codes.ORDER)
            .select("encounter_id", "patient_nbr", codes.ORDER))


def q_select_features(spark, sf_dir) -> DataFrame:
    """The assembled vector, unpacked again into one row per feature."""
    from pyspark.ml.functions import vector_to_array
    from wardlens.operators.models import assemble
    df = durable(q_featured(FULL)(spark, sf_dir), "featured")
    names = feature_names(df, [codes.TARGET, codes.ORDER])
    values = vector_to_array("features")
    return (assemble(df, names).select(codes.ORDER, F.posexplode(values).alias("position", "x"))
            .groupBy("position").agg(F.round(F.sum("x"), 3).alias("total")))


def on(sub):
    """Bind a DataFrame-to-DataFrame operator to the encounters view."""
    return lambda spark, sf_dir: sub(encounters(spark, sf_dir))


def impute_customer(spark, sf_dir) -> DataFrame:
    df = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")).alias("c_acctbal"))
    return (MedianImputer().fit(df).transform(df)
            .withColumn("c_acctbal", F.round("c_acctbal", 6)))


def impute_encounters(spark, sf_dir) -> DataFrame:
    df = encode.encode(encounters(spark, sf_dir), encode.age_midpoint, encode.gender_code)
    df = df.select("encounter_id", "age", "gender")
    return MedianImputer(["age", "gender"]).fit(df).transform(df)


def one_hot_table(name, key, column):
    def run(spark, sf_dir) -> DataFrame:
        df = table(spark, sf_dir, name).select(key, column)
        return encode.OneHot([column]).fit(df).transform(df)
    return run


RANGED_SQL = """SELECT o_orderkey, (o_totalprice % 1000) * 1.0 AS low,
    (o_totalprice % 1000) + CASE WHEN o_orderkey % 50 = 0 THEN 300.0 ELSE (o_orderkey % 7) * 0.25 - 0.25 END AS high,
    o_orderpriority AS label FROM orders"""


def q_range_join(spark, sf_dir) -> DataFrame:
    """Line prices against one range per order: thousands, wide and narrow, overlapping, some the wrong way round."""
    ranges = spark.sql(RANGED_SQL.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr("CASE WHEN l_linenumber < 7 THEN l_extendedprice % 1400 END").alias("price"))
    return label_ranges(lines, "price", ranges, order="o_orderkey", name="band", default="none").drop("price")


def q_one_hot_sparse(spark, sf_dir) -> DataFrame:
    """Places of the ones of an order: clerk and priority, as text."""
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"),
                                               F.col("o_orderpriority").alias("priority"))
    out = encode.SparseOneHot(["customer", "priority"]).fit(df).indices(df)
    return out.select("o_orderkey", F.array_join(F.col("indices").cast("array<string>"), ",").alias("ones"))


def one_hot_sql(name, key, column, kept) -> str:
    cols = ", ".join(f"CAST(coalesce({column} = '{v}', false) AS TINYINT) AS {S.q(column + '_' + v)}"
                     for v in kept)
    return f"SELECT {key}, {cols} FROM {name}"


def coder(encoder):
    return lambda df: encode.encode(df, encoder)


def pick(transform, *cols):
    return on(lambda df: df.transform(transform).select("encounter_id", *[quoted(c) for c in cols]))


def coded_sql(**exprs) -> str:
    cols = ", ".join(f"{e} AS {S.q(c)}" for c, e in exprs.items())
    return S.upto("enc", f"SELECT encounter_id, {cols} FROM enc")


MISSING_SQL = S.upto("enc", "SELECT col AS \"column\", nulls, nulls / rows AS null_share FROM ("
                     + " UNION ALL ".join(
                         f"SELECT {S.text(c)} AS col, count(*) FILTER ({S.q(c)} IS NULL)::BIGINT AS nulls, "
                         f"count(*)::DOUBLE AS rows FROM enc" for c in S.COLUMNS) + ")")


def _contract_sql() -> str:
    kinds = {"encounter_id": "bigint", "patient_nbr": "bigint"}
    rows = []
    for need, group in (("true", REQUIRED), ("false", OPTIONAL)):
        for c in group:
            here = c in S.COLUMNS
            kind = S.text(kinds.get(c, "string")) if here else "NULL"
            nulls = f"(SELECT count(*) FILTER ({S.q(c)} IS NULL) FROM enc)" if here else "CAST(NULL AS BIGINT)"
            rows.append(f"SELECT {S.text(c)} AS \"column\", {need} AS required, {str(here).lower()} AS present, "
                        f"CAST({kind} AS VARCHAR) AS dtype, {nulls} AS nulls")
    return S.upto("enc", " UNION ALL ".join(rows))


def _vector_sql() -> str:
    names = ["gender", "age", *S.PLAIN, "A1Cresult", "max_glu_serum", *S.DRUGS, "change", "diabetesMed",
             *S.FEATURES, *[f"{c}_{v}" for c in S.VOCABULARY for v in S.VOCABULARY[c][1:]]]
    return S.upto("featured", " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS position, round(sum({S.q(c)}::DOUBLE), 3) AS total FROM featured"
        for i, c in enumerate(names)))


QUERIES = {
    "scan_encounters": q_scan_encounters,
    "scan_stage": q_scan_stage,
    "write_stage": q_write_stage,
    "schema_contract": q_contract,
    "first_per_key": on(lambda df: first_per_key(df, ["patient_nbr"], ["encounter_id"])),
    "first_per_key_orders": lambda s, d: first_per_key(
        table(s, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]),
    "first_per_key_events": lambda s, d: first_per_key(
        table(s, d, "events"), ["user_id"], ["ts", "event_id"]),
    "duplicate_count": on(lambda df: duplicate_count(df, ["patient_nbr"])),
    "duplicate_count_lineitem": lambda s, d: duplicate_count(
        table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
    "dense_order": q_dense_order,
    "dense_order_events": q_dense_events,
    "drop_columns": on(lambda df: df.drop(*codes.DROPPED_COLUMNS)),
    "missing_profile": on(profile.missing_profile),
    "binary_target": pick(encode.binary_target, codes.TARGET),
    "target_balance": on(lambda df: profile.target_balance(encode.binary_target(df), codes.TARGET)
                         .withColumn("positive_pct", F.round("positive_pct", 6))),
    "frame_shape": on(profile.frame_shape),
    "frame_shape_cleaned": lambda s, d: profile.frame_shape(q_cleaned(s, d)),
    "select_features": q_select_features,
    "encode_age": pick(coder(encode.age_midpoint), "age"),
    "encode_gender": pick(coder(encode.gender_code), "gender"),
    "encode_flags": pick(coder(encode.flag_codes), "change", "diabetesMed"),
    "encode_a1c": pick(coder(encode.a1c_code), "A1Cresult"),
    "encode_glucose": pick(coder(encode.glucose_code), "max_glu_serum"),
    "encode_medications": pick(coder(encode.dose_codes), *S.DRUGS),
    "map_codes_orders": lambda s, d: table(s, d, "orders").select(
        "o_orderkey", map_codes("o_orderpriority", PRIORITY, 0, "int").alias("priority"),
        map_codes("o_orderstatus", {"F": 1, "O": 2}, None, "int").alias("status")),
    "icd9_category": pick(encode.categorise_diagnoses, "diag_1_cat", "diag_2_cat", "diag_3_cat"),
    "range_bucket": lambda s, d: table(s, d, "part").select(
        "p_partkey", range_label("p_size", SIZES, "other").alias("size_band")),
    "range_join": q_range_join,
    "one_hot_sparse": q_one_hot_sparse,
    "one_hot": on(lambda df: encode.OneHot(["race"]).fit(df).transform(df.select("encounter_id", "race"))),
    "one_hot_orders": one_hot_table("orders", "o_orderkey", "o_orderpriority"),
    "one_hot_part": one_hot_table("part", "p_partkey", "p_type"),
    "one_hot_events": one_hot_table("events", "event_id", "event_type"),
    "median_impute": impute_encounters,
    "median_impute_customer": impute_customer,
    "ratio_round_lineitem": lambda s, d: table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", round_half_even(
            F.col("l_extendedprice") / at_least(F.col("l_quantity"), 1), 3).alias("unit_price")),
    "preprocess_encounters": q_cleaned,
    "preprocess_from_csv": q_preprocess_from_csv,
    "feature_encounters": q_featured(FULL),
    "feature_encounters_compat": q_featured(COMPAT),
    "feature_from_stage": q_features_from_stage,
    "prepare_from_csv": q_prepare_from_csv,
    "class_counts": on(lambda df: profile.class_counts(encode.binary_target(df), codes.TARGET)),
    "positive_rate_pct": on(lambda df: profile.positive_rate_pct(encode.binary_target(df), codes.TARGET)
                            .withColumn("positive_rate_pct", F.round("positive_rate_pct", 6))),
}

_KEPT = [c for c in S.COLUMNS if c not in codes.DROPPED_COLUMNS]
FEATURED_SQL = S.upto("featured", "SELECT * FROM featured")
COMPAT_SQL = S.upto("cleaned", f"SELECT *, {S.feature_list(S.FEATURES_COMPAT)} FROM cleaned")

ORACLES = {
    "scan_encounters": S.upto("enc", "SELECT * FROM enc"),
    "scan_stage": FEATURED_SQL,
    "write_stage": S.upto("cleaned", "SELECT * FROM cleaned"),
    "schema_contract": _contract_sql(),
    "first_per_key": S.upto("firsts", "SELECT * FROM firsts"),
    "first_per_key_orders": "SELECT * FROM orders QUALIFY row_number() OVER "
                            "(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1",
    "first_per_key_events": "SELECT * FROM events QUALIFY row_number() OVER "
                            "(PARTITION BY user_id ORDER BY ts, event_id) = 1",
    "duplicate_count": S.upto("enc", "SELECT count(*) AS rows, count(DISTINCT patient_nbr) AS distinct_keys, "
                                     "count(*) - count(DISTINCT patient_nbr) AS removed FROM enc"),
    "duplicate_count_lineitem": "SELECT sum(n)::BIGINT AS rows, count(*) AS distinct_keys, "
                                "(sum(n) - count(*))::BIGINT AS removed FROM (SELECT count(*) AS n FROM lineitem "
                                "GROUP BY l_orderkey, l_linenumber)",
    "dense_order": S.upto("ordered", "SELECT encounter_id, patient_nbr, encounter_order FROM ordered"),
    "dense_order_events": "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS position FROM events",
    "drop_columns": S.upto("enc", "SELECT " + ", ".join(S.q(c) for c in _KEPT) + " FROM enc"),
    "missing_profile": MISSING_SQL,
    "binary_target": coded_sql(readmitted_lt30=S.TARGET_SQL),
    "target_balance": S.upto("enc", f"SELECT count(*) AS rows, count(*) FILTER (y = 1) AS positives, "
                                    f"count(*) FILTER (y = 0) AS negatives, round(avg(y) * 100, 6) AS positive_pct "
                                    f"FROM (SELECT {S.TARGET_SQL} AS y FROM enc)"),
    "frame_shape": S.upto("enc", f"SELECT count(*) AS rows, {len(S.COLUMNS)}::INTEGER AS \"columns\" FROM enc"),
    "frame_shape_cleaned": S.upto("cleaned", "SELECT count(*) AS rows, 48::INTEGER AS \"columns\" FROM cleaned"),
    "select_features": _vector_sql(),
    "encode_age": coded_sql(age=S.AGE_SQL),
    "encode_gender": coded_sql(gender=S.GENDER_SQL),
    "encode_flags": coded_sql(**S.FLAG_SQL),
    "encode_a1c": coded_sql(A1Cresult=S.A1C_SQL),
    "encode_glucose": coded_sql(max_glu_serum=S.GLUCOSE_SQL),
    "encode_medications": coded_sql(**S.DOSE_SQL),
    "map_codes_orders": "SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS INTEGER) AS priority, "
                        "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END::INTEGER AS status FROM orders",
    "icd9_category": coded_sql(**{f"{c}_cat": S.icd9_sql(c) for c in codes.DIAGNOSIS_COLUMNS}),
    "range_bucket": "SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 10 THEN 'small' WHEN p_size BETWEEN 15 AND 25 "
                    "THEN 'medium' WHEN p_size BETWEEN 30 AND 45 THEN 'large' ELSE 'other' END AS size_band FROM part",
    "range_join": f"""WITH r AS ({RANGED_SQL}),
 l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber < 7 THEN l_extendedprice % 1400 END AS price FROM lineitem),
 d AS (SELECT DISTINCT price FROM l WHERE price IS NOT NULL),
 f AS (SELECT price, arg_min(label, o_orderkey) AS label FROM d JOIN r ON price BETWEEN low AND high GROUP BY price)
 SELECT l_orderkey, l_linenumber, coalesce(label, 'none') AS band FROM l LEFT JOIN f USING (price)""",
    "one_hot_sparse": """WITH c AS (SELECT v, row_number() OVER (ORDER BY v) - 2 AS place
   FROM (SELECT DISTINCT o_custkey::VARCHAR AS v FROM orders)),
 p AS (SELECT v, row_number() OVER (ORDER BY v) - 2 AS place FROM (SELECT DISTINCT o_orderpriority AS v FROM orders))
 SELECT o_orderkey, concat_ws(',', CASE WHEN c.place >= 0 THEN c.place END,
     CASE WHEN p.place >= 0 THEN p.place + (SELECT count(*) - 1 FROM c) END) AS ones
 FROM orders LEFT JOIN c ON o_custkey::VARCHAR = c.v LEFT JOIN p ON o_orderpriority = p.v""",
    "one_hot": S.upto("enc", f"SELECT encounter_id, {S.dummies(['race'])} FROM enc"),
    "one_hot_orders": one_hot_sql("orders", "o_orderkey", "o_orderpriority", list(PRIORITY)[1:]),
    "one_hot_part": one_hot_sql("part", "p_partkey", "p_type", ["LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]),
    "one_hot_events": one_hot_sql("events", "event_id", "event_type", ["error", "purchase", "signup", "view"]),
    "median_impute": S.upto("enc", f"SELECT encounter_id, coalesce(age, median(age) OVER ()) AS age, "
                                   f"coalesce(gender, median(gender) OVER ()) AS gender FROM "
                                   f"(SELECT encounter_id, {S.AGE_SQL} AS age, {S.GENDER_SQL} AS gender FROM enc)"),
    "median_impute_customer": "WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS b "
                              "FROM customer) SELECT c_custkey, round(coalesce(b, (SELECT median(b) FROM c)), 6) "
                              "AS c_acctbal FROM c",
    "ratio_round_lineitem": "SELECT l_orderkey, l_linenumber, " + S.half_even(
        "l_extendedprice / (CASE WHEN l_quantity < 1 THEN 1 ELSE l_quantity END)")
        + " AS unit_price FROM lineitem",
    "preprocess_encounters": S.upto("cleaned", "SELECT * FROM cleaned"),
    "preprocess_from_csv": S.upto("cleaned", "SELECT * FROM cleaned"),
    "feature_encounters": FEATURED_SQL,
    "feature_encounters_compat": COMPAT_SQL,
    "feature_from_stage": COMPAT_SQL,
    "prepare_from_csv": FEATURED_SQL,
    "class_counts": S.upto("enc", f"SELECT {S.TARGET_SQL} AS value, count(*) AS rows FROM enc GROUP BY 1"),
    "positive_rate_pct": S.upto("enc", f"SELECT round(avg({S.TARGET_SQL}) * 100, 6) AS positive_rate_pct FROM enc"),
}



def feature_of(column):
    """One derived feature over every encounter: a narrow plan without a shuffle."""
    return on(lambda df: derive_features(code_columns(df)).select("encounter_id", column))


for _c, _e in S.FEATURES.items():
    QUERIES[_c] = feature_of(_c)
    ORACLES[_c] = (S.upto("enc", "") + f", every AS ({S.coded_select('encounter_id', 'enc')}) "
                   f"SELECT encounter_id, {_e} AS {S.q(_c)} FROM every")
