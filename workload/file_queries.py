"""Sources, raw contract, landing, profiles and sinks, over files and rows that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from casemart.functions import parse_report_date
from casemart.operators.columns import find_column
from casemart.operators.quality import quality_report
from casemart.operators.storage import scratch_path
from casemart.plans import views
from casemart.sinks import files, publish, snapshot
from casemart.sources import catalog, contract, landing, profile
from casemart.sources.files import csv_groups, flatten_envelope, read_case_files, read_csv
from casemart.sources.paths import list_files
from workload import oracle as o
from workload.frames import DOMAIN, SETTINGS, feed, layers, order_gold, order_layers, order_star, stored_feed, table

# The feed's columns as the raw contract names them.
FEED_FIELDS = ("_id", "วันที่เริ่มป่วย", "ปี", "ชื่อกลุ่มโรค", "อำเภอ/เขต", "เพศ", "อายุ (เต็ม) ปี", "จำนวน")


# -- file versions ---------------------------------------------------------------------------------


def order_paths(spark, sf_dir):
    """A path per order: full files with and without a version, samples, unfinished files and notes."""
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    year = (F.year(date) + 543).cast("string")
    version = F.date_format(date, "yyyyMMdd")
    name = (
        F.when(key % 5 == 0, F.concat(F.lit("_sample.json"))).when(key % 5 == 1, F.lit("_full.csv"))
        .when(key % 5 == 2, F.concat(F.lit("_full_"), version, F.lit(".csv.part")))
        .when((key % 5 == 3) & (F.year(date) % 4 != 0), F.concat(F.lit("_full_"), version, F.lit(".csv"))).otherwise("_notes.txt")
    )
    folder = F.when(key % 2 == 0, F.concat(F.lit("lake/year="), year, F.lit("/"))).otherwise("D:\\raw\\")
    # 1998 has nothing but samples.
    kept = F.when(F.year(date) == 1998, F.lit("_sample.json")).otherwise(name)
    return table(spark, sf_dir, "orders").select(F.concat(folder, F.lit("disease_cases_"), year, kept).alias("path"))


PATHS_SQL = """paths AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'lake/year=' || y || '/' ELSE 'D:\\raw\\' END || 'disease_cases_' || y ||
    CASE WHEN year(o_orderdate) = 1998 THEN '_sample.json' WHEN o_orderkey % 5 = 0 THEN '_sample.json' WHEN o_orderkey % 5 = 1 THEN '_full.csv'
         WHEN o_orderkey % 5 = 2 THEN '_full_' || v || '.csv.part'
         WHEN o_orderkey % 5 = 3 AND year(o_orderdate) % 4 <> 0 THEN '_full_' || v || '.csv' ELSE '_notes.txt' END AS path
  FROM (SELECT *, year(o_orderdate) + 543 AS y, strftime(o_orderdate, '%Y%m%d') AS v FROM orders)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY kind = 'full' DESC, version DESC, path DESC) AS rn,
                  row_number() OVER (PARTITION BY year, kind ORDER BY version DESC, path DESC) AS rk
  FROM (SELECT path, regexp_extract(path, p, 1) AS year, regexp_extract(path, p, 2) AS kind, regexp_extract(path, p, 3) AS version
        FROM paths, (SELECT 'disease_cases_([0-9]{4})_(full|sample)(?:_([0-9]{8}))?[.](csv|json)$' AS p)) WHERE year <> '')"""


def signed_paths(spark, sf_dir):
    """The same paths with a checksum that differs between some offers and what has landed."""
    return order_paths(spark, sf_dir).distinct().withColumn("sha256", F.sha2(F.regexp_replace("path", "^.*disease", ""), 256))


def content_status(spark, sf_dir):
    offered = signed_paths(spark, sf_dir)
    changed = F.substring("sha256", 1, 1) < "8"
    landed = offered.withColumn("sha256", F.when(changed, F.lit("old")).otherwise(F.col("sha256")))
    return landing.content_status(offered, landed)


CONTENT_SQL = o.query(PATHS_SQL, select="""SELECT year, CASE WHEN substr(sha256(regexp_replace(path, '^.*disease', '')), 1, 1) < '8'
  THEN 'new' ELSE 'unchanged' END AS status FROM ranked WHERE kind = 'full' AND rk = 1""")


# -- landing ---------------------------------------------------------------------------------------


def landing_status(spark, sf_dir):
    """Pages offered again: some with other content, some for the first time, some not offered."""
    pages, key = table(spark, sf_dir, "pages"), F.col("page_id")
    signed = pages.select("page_id", F.concat_ws("#", "url", "page_id").alias("object_key"), F.sha2("html", 256).alias("sha256"))
    incoming = signed.where(key % 7 != 0)
    landed = signed.where(key % 5 != 0).withColumn("sha256", F.when(key % 3 == 0, F.lit("other")).otherwise(F.col("sha256")))
    return landing.landing_status(incoming, landed)


LANDING_SQL = """SELECT url || '#' || page_id AS object_key, CASE WHEN page_id % 5 = 0 THEN 'new' WHEN page_id % 7 = 0 THEN 'kept'
  WHEN page_id % 3 = 0 THEN 'conflict' ELSE 'unchanged' END AS status FROM pages WHERE page_id % 7 <> 0 OR page_id % 5 <> 0"""


def feed_files(spark, sf_dir):
    """The feed written as CSV, one folder per file year."""
    path = scratch_path(spark, "raw")
    year = F.regexp_extract("_source_file", r"_(\d{4})_", 1)
    feed(spark, sf_dir).withColumn("file_year", year).drop("_source_file").write.partitionBy("file_year").options(
        **files.CSV_OPTIONS).csv(path)
    return path


def year_of(path):
    return F.regexp_extract(path, r"file_year=(\d{4})", 1)


def written_paths(spark, path):
    """Paths of the files just written; as many as Spark wrote, never one per row."""
    return [row.path for row in list_files(spark, path, "*.csv", recursive=True).select("path").collect()]


def csv_contract(spark, sf_dir):
    paths = written_paths(spark, feed_files(spark, sf_dir))
    checked = contract.csv_contract(spark, paths, FEED_FIELDS)
    return checked.groupBy(year_of("path").alias("file_year"), "status").agg(
        F.sum("records").alias("records"), F.sum("ragged_records").alias("ragged_records"))


def case_files(spark, sf_dir):
    """Records read back from the year files, each with its own id."""
    records = read_case_files(spark, written_paths(spark, feed_files(spark, sf_dir)))
    named = records.withColumn("file_year", year_of("_source_file"))
    # ids are counted as 32 bytes: a quarter of their text
    return named.groupBy("file_year").agg(
        F.count("*").alias("records"), F.count_distinct(F.unhex(F.sha2("_record_id", 256))).alias("record_ids"),
        F.count("`วันที่เริ่มป่วย`").alias("dated"), F.count_distinct("`อำเภอ/เขต`").alias("districts"))


FILE_YEAR = "regexp_extract(source_file, '_([0-9]{4})_', 1) AS file_year"


def manifest(spark, sf_dir):
    path = feed_files(spark, sf_dir)
    prints = landing.fingerprints(spark, f"{path}/*/*.csv")
    counts = contract.csv_contract(spark, written_paths(spark, path), FEED_FIELDS)
    rows = landing.manifest(prints, counts, "cases", "feed", F.regexp_extract("path", r"file_year=(\d{4})", 1), F.col("path"))
    complete = (F.length("sha256") == 64) & (F.col("size_bytes") > 0) & (F.col("format") == "csv")
    return rows.groupBy("year_be").agg(F.sum("record_count").alias("records"), F.bool_and(complete).alias("complete"))


def json_contract(spark, sf_dir):
    """A JSON document of two records per event; some have other fields, no records or are no JSON."""
    key = F.col("event_id")
    one = F.to_json(F.struct(F.col("event_id").cast("string").alias("k"), F.col("event_type").alias("t")))
    other = F.to_json(F.struct(F.col("event_type").alias("t")))
    value = (
        F.when(key % 10 == 0, F.concat(F.lit("["), one, F.lit(","), other, F.lit("]")))
        .when(key % 10 == 1, F.lit("[]")).when(key % 10 == 2, F.concat(F.lit("["), one))
        .when(key % 10 == 3, F.concat(F.lit("["), one, F.lit("] and more")))
        .when(key % 10 == 4, F.concat(F.lit(" ["), one, F.lit("]\n "))).when(key % 10 == 5, F.concat(F.lit("["), one, F.lit("]]")))
        .otherwise(F.concat(F.lit("["), one, F.lit(","), one, F.lit("]")))
    )
    documents = table(spark, sf_dir, "events").select(key.cast("string").alias("path"), value.alias("value"))
    return contract.json_document_contract(documents, ("k", "t"))


JSON_SQL = """SELECT CAST(event_id AS VARCHAR) AS path, CAST(CASE event_id % 10 WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 0 WHEN 4 THEN 1 WHEN 5 THEN 0 ELSE 2 END AS BIGINT) AS records,
  CAST(CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS wrong_records,
  CASE event_id % 10 WHEN 0 THEN 'wrong_fields' WHEN 1 THEN 'empty' WHEN 2 THEN 'not_json' WHEN 3 THEN 'not_json' WHEN 5 THEN 'not_json' ELSE 'ok' END AS status FROM events"""


# -- reading and writing ---------------------------------------------------------------------------


def envelope(spark, sf_dir):
    """Orders wrapped two to a document under `records`."""
    first = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("kind"))
    second = F.struct(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("kind"))
    wrapped = table(spark, sf_dir, "orders").select(
        F.array(first, second).alias("records"), F.concat(F.lit("f"), F.col("o_orderkey") % 10).alias("_source_file"))
    return flatten_envelope(wrapped)


def conversation_csv(spark, sf_dir):
    """Free text with quotes, commas and line breaks through CSV and back, as strings."""
    path = scratch_path(spark, "csv")
    data = table(spark, sf_dir, "conversations")
    data.write.options(**files.CSV_OPTIONS).csv(path)
    back = read_csv(spark, [path], data.columns)
    return back.select(*data.columns)


def found_columns(spark, sf_dir):
    """Columns resolved by spelling, shown as the counts of what they hold."""
    raw = feed(spark, sf_dir)
    spelled = DOMAIN.case_columns
    picks = {name: find_column(raw, spellings) for name, spellings in spelled.items()}
    return raw.agg(*[F.count(f"`{column}`").alias(name) for name, column in picks.items() if column])


def parquet_round_trip(spark, sf_dir):
    path = scratch_path(spark, "gold")
    files.write_parquet(order_gold(spark, sf_dir), path, partition_by=["year_be"])
    return spark.read.parquet(path).select(
        F.col("year_be").cast("int").alias("year_be"), "district_name", "disease_name", "total_cases", "population",
        "incidence_rate_per_100k", "source_records")


def csv_export(spark, sf_dir):
    path = scratch_path(spark, "fact.csv")
    star = order_star(spark, sf_dir)
    fact = files.ordered_export("fact_disease_cases", star.fact_disease_cases)
    files.write_export(fact, path, "csv")
    (_, names), _paths = next(iter(csv_groups(spark, [path]).items()))
    text = files.select_by_header(read_csv(spark, [path], names), names)
    return text.select(*[F.col(c).cast(fact.schema[c].dataType).alias(c) for c in names])


def published(spark, sf_dir):
    """A mart published and looked up again, together with its audit row."""
    root = scratch_path(spark, "mart")
    found = layers(spark, sf_dir)
    publish.publish(found.star, quality_report(found, SETTINGS, DOMAIN), root, "feed")
    return root


def publish_audit(spark, sf_dir):
    audit = publish.read_audit(spark, published(spark, sf_dir))
    return audit.select("load_id", F.explode("row_counts").alias("table_name", "rows"))


def view_of_published(spark, sf_dir):
    star, _ = publish.current_mart(spark, published(spark, sf_dir))
    return views.year_disease(star)


AUDIT_TABLES = ("dim_date", "dim_district", "dim_disease", "dim_age_group", "dim_sex", "fact_disease_cases", "fact_population")
PUBLISH_SQL = o.over_feed(
    "\nUNION ALL ".join(f"SELECT CAST(1 AS BIGINT) AS load_id, '{n}' AS table_name, count(*) AS rows FROM {n}" for n in AUDIT_TABLES)
    + "\nUNION ALL SELECT 1, 'data_quality', count(*) FROM report", o.quality())


def order_snapshot(spark, sf_dir):
    found = order_layers(spark, sf_dir)
    return snapshot.snapshot(found.star, quality_report(found, SETTINGS, DOMAIN))


def order_document(spark, sf_dir):
    """The pieces of one JSON document; the newest order stands for the newest load."""
    found = order_layers(spark, sf_dir)
    audit = table(spark, sf_dir, "orders").select(F.to_timestamp_ltz(F.max("o_orderdate").cast("date").cast("string")).alias("loaded_at"))
    return snapshot.document(found.star, quality_report(found, SETTINGS, DOMAIN), audit, scratch_path(spark, "document"))


def section_sql(name, source, payload, order, chunk):
    return (f"SELECT '{name}' AS section, {chunk} AS chunk, count(*) AS records, "
            f"'[' || string_agg({payload}, ',' ORDER BY {order}) || ']' AS payload FROM {source} GROUP BY 2")


def record_sql(**fields):
    cells = []
    for key, (column, quoted) in fields.items():
        value = f"'\"' || {column} || '\"'" if quoted else f"CAST({column} AS VARCHAR)"
        cells.append(f"'\"{key}\":' || {value}")
    return "'{' || " + " || ',' || ".join(cells) + " || '}'"


SNAPSHOT_SQL = o.over_orders("\nUNION ALL ".join([
    section_sql("fact", "fact_disease_cases",
                "'[' || date_key || ',' || district_key || ',' || disease_key || ',' || age_group_key || ',\"' || sex || '\",' || total_cases || ']'",
                "disease_key, age_group_key, sex", "date_key || '-' || district_key || '-' || (disease_key // 1000)"),
    section_sql("dim_date", "dim_date",
                record_sql(k=("date_key", 0), m=("strftime(month_start, '%Y-%m')", 1), label=("month_label", 1), y=("year_be", 0)),
                "date_key", "CAST(year_be AS VARCHAR)"),
    section_sql("dim_district", "(SELECT * FROM dim_district WHERE is_bangkok_district)",
                record_sql(k=("district_key", 0), name=("district_name", 1)), "district_key", "CAST(district_key // 1000 AS VARCHAR)"),
    section_sql("dim_disease", "dim_disease", record_sql(k=("disease_key", 0), name=("disease_name", 1)), "disease_key",
                "CAST(disease_key // 1000 AS VARCHAR)"),
    section_sql("dim_age", "dim_age_group", record_sql(k=("age_group_key", 0), label=("age_group", 1)), "age_group_key", "'all'"),
    section_sql("dim_sex", "dim_sex", record_sql(k=("sex", 1), label=("sex_label", 1)), "sex", "'all'"),
    section_sql("population", "fact_population", record_sql(y=("year_be", 0), k=("district_key", 0), p=("population", 0)),
                "district_key", "year_be || '-' || (district_key // 1000)"),
    section_sql("period", "vw_year_period", record_sql(y=("year_be", 0), months=("months_covered", 0), label=("period_label", 1)),
                "year_be", "'all'"),
    section_sql("dq", "report", record_sql(**{name: (name, 1) for name in ("layer", "rule", "observed", "threshold", "status")}), "layer, rule", "'all'"),
]), o.GOLD, o.ORDER_LAYERS, o.quality())


DOCUMENT_SQL = f"""WITH parts AS (
  SELECT *, list_position([{', '.join(f"'{name}'" for name in snapshot.SECTIONS)}], section) AS number,
         list_transform(string_split(chunk, '-'), lambda x: try_cast(x AS BIGINT)) AS keys FROM ({SNAPSHOT_SQL})),
placed AS (
  SELECT *, row_number() OVER (ORDER BY number, keys) AS position, row_number() OVER (PARTITION BY number ORDER BY keys) AS n,
         count(*) OVER (PARTITION BY number) AS of_section FROM parts),
pieces AS (
  SELECT position, CASE WHEN n = 1 THEN CASE WHEN number = 1 THEN '{{' ELSE ',' END || '"' || section || '":[' ELSE ',' END || substr(payload, 2, length(payload) - 2)
         || CASE WHEN n = of_section THEN ']' ELSE '' END
         || CASE WHEN n = of_section AND number = {len(snapshot.SECTIONS)} THEN ',"loaded_at":"' || (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM orders) || ' 07:00"}}' ELSE '' END AS text
  FROM placed)
SELECT position, CAST(coalesce(sum(strlen(text) + 1) OVER (ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset", text FROM pieces"""


# -- profiles --------------------------------------------------------------------------------------


def profile_sql(name: str, columns: list[str]) -> str:
    empty = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in columns)
    return (f"SELECT count(*) AS rows, {len(columns)} AS columns, CAST(sum({empty}) AS BIGINT) AS missing_cells, "
            f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(columns)} FROM {name})) AS duplicate_rows FROM {name}")


DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def labelled_documents(spark, sf_dir):
    """Documents with their labels where they have any."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").select(
        *DOCUMENT_COLUMNS, "quality", "toxic")


LABELLED_SQL = "labelled AS (SELECT doc_id, text, lang, source, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"
VALUE_COUNTS_SQL = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS rows FROM labelled GROUP BY ALL" for c in ("lang", "source", "quality"))


def raw_date_range(spark, sf_dir):
    return profile.date_range(stored_feed(spark, sf_dir), "วันที่เริ่มป่วย", parse_report_date)


QUERIES = {
    "raw_versions": (
        lambda s, d: catalog.latest_per_year(order_paths(s, d)),
        o.query(PATHS_SQL, select="SELECT year, path FROM ranked WHERE rn = 1")),
    "raw_latest_full": (
        lambda s, d: catalog.latest_full(order_paths(s, d)),
        o.query(PATHS_SQL, select="SELECT year, path FROM ranked WHERE kind = 'full' AND rk = 1")),
    "raw_content_status": (content_status, CONTENT_SQL),
    "raw_landing_status": (landing_status, LANDING_SQL),
    "raw_contract_csv": (
        csv_contract,
        o.query(o.FEED, select=f"SELECT {FILE_YEAR}, 'ok' AS status, count(*) AS records, CAST(0 AS BIGINT) AS ragged_records FROM feed GROUP BY ALL")),
    "raw_contract_json": (json_contract, JSON_SQL),
    "raw_manifest": (
        manifest,
        o.query(o.FEED, select=f"SELECT {FILE_YEAR.replace('file_year', 'year_be')}, count(*) AS records, TRUE AS complete FROM feed GROUP BY ALL")),
    "raw_profile": (
        lambda s, d: profile.table_profile(labelled_documents(s, d)),
        o.query(LABELLED_SQL, select=profile_sql("labelled", [*DOCUMENT_COLUMNS, "quality", "toxic"]))),
    "raw_value_counts": (
        lambda s, d: profile.value_counts(labelled_documents(s, d), ["lang", "source", "quality"]),
        o.query(LABELLED_SQL, select=VALUE_COUNTS_SQL)),
    "raw_distinct": (
        lambda s, d: profile.distinct_values(labelled_documents(s, d), ["lang", "source", "toxic"]),
        o.query(LABELLED_SQL, select=" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM labelled" for c in ("lang", "source", "toxic")))),
    "raw_missing": (
        lambda s, d: profile.missing_cells(labelled_documents(s, d)),
        o.query(LABELLED_SQL, select=" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_cells FROM labelled" for c in (*DOCUMENT_COLUMNS, "quality", "toxic")))),
    "raw_date_range": (
        raw_date_range,
        o.query(o.FEED, select=f"SELECT min(x) AS earliest, max(x) AS latest, count(*) - count(x) AS unreadable FROM (SELECT {o.date('onset')} AS x FROM feed)")),
    "raw_subset_sums": (
        lambda s, d: profile.subset_sums(table(s, d, "lineitem"), "l_returnflag", ["A", "N"], ["l_quantity", "l_linenumber"]),
        "SELECT count(*) AS rows, sum(l_quantity) AS l_quantity, CAST(sum(l_linenumber) AS DOUBLE) AS l_linenumber "
        "FROM lineitem WHERE l_returnflag IN ('A', 'N')"),
    "src_columns": (
        found_columns,
        o.query(o.FEED, select="SELECT count(id) AS case_id, count(onset) AS report_date, count(stated_year) AS year, count(disease) AS disease_name, "
                               "count(district) AS district_name, count(sex) AS sex, count(age) AS age, count(cases) AS case_count FROM feed")),
    "src_envelope": (
        envelope,
        "SELECT o_orderkey AS id, o_orderpriority AS kind, 'f' || (o_orderkey % 10) AS _source_file FROM orders "
        "UNION ALL SELECT o_custkey, o_orderstatus, 'f' || (o_orderkey % 10) FROM orders"),
    "src_csv": (
        conversation_csv,
        "SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, text FROM conversations"),
    "src_case_files": (
        case_files,
        o.query(o.FEED, select=f"SELECT {FILE_YEAR}, count(*) AS records, count(*) AS record_ids, count(onset) AS dated, "
                               "count(DISTINCT district) AS districts FROM feed GROUP BY ALL")),
    "sink_parquet": (
        parquet_round_trip,
        o.query(o.ORDER_CASES, o.ORDER_POPULATION, "population AS (SELECT * FROM known_population)", o.GOLD, select="SELECT * FROM gold")),
    "sink_csv": (csv_export, o.over_orders("SELECT * FROM fact_disease_cases")),
    "sink_publish": (publish_audit, PUBLISH_SQL),
    "sink_published_view": (view_of_published, o.over_feed("SELECT * FROM vw_year_disease", o.VIEWS)),
    "json_snapshot": (order_snapshot, SNAPSHOT_SQL),
    "json_document": (order_document, DOCUMENT_SQL),
}
