"""End-to-end runs, raw files with planted faults, scans of folders, fan-out and ordered exports, over the given tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from casemart import Layout, Settings
from casemart.operators.columns import clean_headers
from casemart.operators.denominators import no_population
from casemart.operators.gold import gold_table
from casemart.operators.quality import quality_report
from casemart.operators.ranking import positioned
from casemart.operators.storage import scratch_path
from casemart.plans.run import Input, run_layers
from casemart.sinks import files, publish
from casemart.sources import contract
from casemart.sources.files import read_case_files, read_cases
from casemart.sources.json_arrays import read_json_arrays
from casemart.sources.paths import SourceNotFound, list_files
from casemart.sources.population import read_population
from casemart.sources.records import thai_code_page
from workload import oracle as o
from workload.file_queries import PUBLISH_SQL
from workload.frames import (
    DOMAIN, SETTINGS, feed_population, order_cases, order_gold, order_layers, order_population, order_star, stored_feed, table, year_span,
)

FILE_KEYS = 16384  # keys that one written file holds


# -- runs ------------------------------------------------------------------------------------------


def run(spark, sf_dir, layout, population=True, settings=SETTINGS, raw=None, **options):
    """The whole run over the untidy feed."""
    raw = stored_feed(spark, sf_dir) if raw is None else raw
    return run_layers(spark, layout, Input(sf_dir, lambda: raw), Input(sf_dir, lambda: feed_population(spark, sf_dir)) if population else None, settings, DOMAIN, **options)


def run_population(spark, sf_dir):
    """What a run with denominators publishes; the feed breaks a rule on purpose, so the gate is opened."""
    layout = Layout(scratch_path(spark, "lake"))
    run(spark, sf_dir, layout, publish_failed=True)
    return publish.read_audit(spark, layout.mart).select("load_id", F.explode("row_counts").alias("table_name", "rows"))


def run_cases_only(spark, sf_dir):
    """What the published mart holds if there are no denominators."""
    layout = Layout(scratch_path(spark, "lake"))
    run(spark, sf_dir, layout, population=False)
    star, quality = publish.current_mart(spark, layout.mart)
    facts = star.fact_disease_cases.agg(F.sum("total_cases").alias("cases"), F.count("*").alias("fact_rows"))
    people = star.fact_population.agg(F.count("*").alias("population_rows"))
    rated = spark.read.parquet(layout.layer("gold")).agg(F.count("*").alias("gold_rows"), F.count("incidence_rate_per_100k").alias("rated_rows"))
    skipped = quality.where("status = 'SKIP'").agg(F.count("*").alias("skipped_rules"))
    return facts.select(
        "cases", "fact_rows", people.scalar().alias("population_rows"), rated.select("gold_rows").scalar().alias("gold_rows"),
        rated.select("rated_rows").scalar().alias("rated_rows"), skipped.scalar().alias("skipped_rules"))


CASES_ONLY_SQL = o.over_feed("""SELECT CAST(sum(total_cases) AS BIGINT) AS cases, count(*) AS fact_rows, CAST(0 AS BIGINT) AS population_rows,
  (SELECT count(*) FROM gold) AS gold_rows, CAST(0 AS BIGINT) AS rated_rows, CAST(1 AS BIGINT) AS skipped_rules FROM fact_disease_cases""")


def run_gate(spark, sf_dir):
    """A run that breaks rules under strict settings: nothing is published, and the report says why."""
    layout = Layout(scratch_path(spark, "lake"))
    result = run(spark, sf_dir, layout, settings=Settings(maximum_age=120, min_retention_rate=1.0))
    loads = publish.read_audit(spark, layout.mart).count()
    report = spark.read.parquet(layout.layer("quality"))
    return report.where("status = 'FAIL' AND rule = 'clean_retention_rate'").select(
        "rule", "observed", "threshold", F.lit(result.failed).alias("failed"), F.lit(loads).cast("long").alias("loads"))


GATE_SQL = o.over_feed("""SELECT 'clean_retention_rate' AS rule, observed, '>= 1' AS threshold, TRUE AS failed, CAST(0 AS BIGINT) AS loads
  FROM report WHERE rule = 'clean_retention_rate'""", o.quality())


class DriverLost(RuntimeError):
    """Stands for a driver that ends in the middle of a run."""


def run_resumed(spark, sf_dir):
    """A run that ends at the denominators, and a second one over the same input: which layers were there already, and their rows."""
    layout, raw = Layout(scratch_path(spark, "lake")), stored_feed(spark, sf_dir)

    def lost():
        raise DriverLost

    cases = Input(sf_dir, lambda: raw)
    try:
        run_layers(spark, layout, cases, Input(sf_dir, lost), SETTINGS, DOMAIN)
    except DriverLost:
        pass
    result = run(spark, sf_dir, layout, raw=raw)
    layers = [(name, rows, reused) for name, rows, reused in result.layers if rows is not None]
    return spark.createDataFrame(layers, "layer string, rows long, reused boolean")


LAYER_SOURCES = (("raw_records", "feed", True), ("tagged", "tagged", True), ("quarantine", "tagged WHERE _quarantine_reason IS NOT NULL", True), ("clean", "deduplicated", True),
                 ("standardized", "cases", True), ("population", "population", False), ("gold", "gold", False), ("quality", "report", False))
RESUMED_SQL = o.over_feed("\nUNION ALL ".join(
    f"SELECT '{name}' AS layer, count(*) AS rows, {str(reused).upper()} AS reused FROM {source}" for name, source, reused in LAYER_SOURCES), o.quality())


# -- raw files with planted faults -----------------------------------------------------------------


def write_lines(lines, path):
    """Rows of `kind, bucket, ord, value` as one text file for each kind and bucket, in order of `ord`.

    They are dealt out by a hash of both: a repartition by the columns themselves is left out where joins below it are planned with that partitioning,
    which is lost when AQE turns such a join into a broadcast one.
    """
    ordered = lines.repartition(F.xxhash64("kind", "bucket")).sortWithinPartitions("kind", "bucket", "ord")
    ordered.select("kind", "bucket", "value").write.partitionBy("kind", "bucket").text(path)
    return [row.path for row in list_files(lines.sparkSession, path, "part-*", recursive=True).select("path").collect()]


def kind_of(path):
    return F.regexp_extract(path, r"kind=(\d+)", 1).cast("int").alias("kind")


def order_lines(spark, sf_dir):
    """Orders as CSV records of two lines (kinds 0 to 3), with ragged rows (1), blank lines (2), another header (3), bytes of a single-byte code page (4), none (5), an open quote (6)."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    placed = table(spark, sf_dir, "orders").select("*", (key % 7).alias("kind"), F.floor(key / FILE_KEYS).alias("bucket"))
    begin = F.concat(F.lit('"'), key.cast("string"), F.lit('","'), F.col("o_orderstatus"), F.lit('"'))
    two_lines = F.concat(begin, F.lit(',"'), F.col("o_orderpriority"), F.lit(' said ""so""\n'), cust.cast("string"), F.lit('"'))
    text = (
        F.when((F.col("kind") == 1) & (cust % 50 == 1), begin).when((F.col("kind") == 2) & (cust % 50 == 2), F.concat(two_lines, F.lit("\n")))
        .when(F.col("kind") < 4, two_lines).when(F.col("kind") == 4, F.concat(begin.cast("binary"), F.unhex(F.lit("2C22A1A222"))).cast("string"))
        .otherwise(F.concat(begin, F.lit(',"x"')))
    )
    records = placed.where("kind <> 5").select("kind", "bucket", key.cast("long").alias("ord"), text.alias("value"))
    sheets = placed.select("kind", "bucket").distinct()
    third = F.when(F.col("kind") == 3, "other").otherwise("note")
    heads = sheets.select("kind", "bucket", F.lit(-1).cast("long").alias("ord"), F.concat(F.lit('key,"status",'), third).alias("value"))
    ends = sheets.where("kind = 6").select("kind", "bucket", F.lit(1 << 62).alias("ord"), F.lit('"open').alias("value"))
    return heads.unionByName(records).unionByName(ends)


def faulty_csv(spark, sf_dir):
    paths = write_lines(order_lines(spark, sf_dir), scratch_path(spark, "faulty-csv"))
    checked = contract.csv_contract(spark, paths, ("key", "status", "note"))
    return checked.groupBy(kind_of("path"), "status").agg(
        F.count("*").alias("files"), *[F.sum(name).alias(name) for name in ("records", "ragged_records", "blank_lines", "first_fault")])


FAULTY_CSV_SQL = f"""WITH placed AS (
  SELECT *, CAST(o_orderkey % 7 AS INTEGER) AS kind, o_orderkey // {FILE_KEYS} AS bucket,
         (o_orderkey % 7 = 1 AND o_custkey % 50 = 1) AS ragged, (o_orderkey % 7 = 2 AND o_custkey % 50 = 2) AS blank FROM orders),
numbered AS (SELECT *, row_number() OVER (PARTITION BY kind, bucket ORDER BY o_orderkey) AS n FROM placed),
sheets AS (
  SELECT kind, bucket, count(*) AS orders, count(*) FILTER (ragged) AS ragged, count(*) FILTER (blank) AS blanks, min(n) FILTER (ragged) AS first_ragged,
         min(n) FILTER (blank) AS first_blank FROM numbered GROUP BY kind, bucket),
judged AS (
  SELECT kind, CASE kind WHEN 3 THEN 'wrong_header' WHEN 4 THEN 'not_utf8' WHEN 5 THEN 'empty' WHEN 6 THEN 'open_quote'
                         ELSE CASE WHEN ragged + blanks > 0 THEN 'ragged' ELSE 'ok' END END AS status,
         CASE kind WHEN 5 THEN 0 WHEN 6 THEN orders + 1 ELSE orders END AS records, CASE kind WHEN 6 THEN 1 ELSE ragged END AS ragged_records, blanks AS blank_lines,
         CASE kind WHEN 1 THEN 2 * first_ragged WHEN 2 THEN 2 * first_blank + 2 WHEN 6 THEN orders + 2 END AS first_fault FROM sheets)
SELECT kind, status, count(*) AS files, CAST(sum(records) AS BIGINT) AS records, CAST(sum(ragged_records) AS BIGINT) AS ragged_records,
       CAST(sum(blank_lines) AS BIGINT) AS blank_lines, CAST(sum(first_fault) AS BIGINT) AS first_fault FROM judged GROUP BY kind, status"""


def event_lines(spark, sf_dir):
    """Events as JSON arrays: good ones (kind 0), some with other fields (1), none (2), a tail behind the bracket (3), no closing bracket (4)."""
    key = F.col("event_id")
    placed = table(spark, sf_dir, "events").select("*", (key % 5).alias("kind"), F.floor(key / FILE_KEYS).alias("bucket"))
    good = F.to_json(F.struct(key.cast("string").alias("k"), F.concat(F.col("event_type"), F.lit(', "]}')).alias("t")))
    other = F.to_json(F.struct(F.col("event_type").alias("t")))
    first = placed.groupBy("kind", "bucket").agg(F.min("event_id").alias("first"))
    comma = F.when(key == F.col("first"), "").otherwise(",")
    record = F.when((F.col("kind") == 1) & (key % 50 == 1), other).otherwise(good)
    records = placed.where("kind <> 2").join(first, ["kind", "bucket"]).select("kind", "bucket", key.cast("long").alias("ord"), F.concat(comma, record).alias("value"))
    ends = F.array(F.struct(F.lit(-1).cast("long").alias("ord"), F.lit("[").alias("value")),
                   F.struct(F.lit(1 << 62).alias("ord"), F.when(F.col("kind") == 3, "] tail").when(F.col("kind") == 4, " ").otherwise("]").alias("value")))
    return records.unionByName(first.select("kind", "bucket", F.inline(ends)))


def faulty_json(spark, sf_dir):
    paths = write_lines(event_lines(spark, sf_dir), scratch_path(spark, "faulty-json"))
    checked = contract.json_contract(spark, paths, ("k", "t"))
    return checked.groupBy(kind_of("path"), "status").agg(
        F.count("*").alias("files"), F.sum("records").alias("records"), F.sum("wrong_records").alias("wrong_records"))


FAULTY_JSON_SQL = f"""WITH sheets AS (
  SELECT CAST(event_id % 5 AS INTEGER) AS kind, count(*) AS events, count(*) FILTER (event_id % 5 = 1 AND event_id % 50 = 1) AS others
  FROM events GROUP BY event_id % 5, event_id // {FILE_KEYS})
SELECT kind, CASE WHEN kind = 2 THEN 'empty' WHEN kind > 2 THEN 'not_json' WHEN others > 0 THEN 'wrong_fields' ELSE 'ok' END AS status, count(*) AS files,
       CAST(sum(CASE WHEN kind < 2 THEN events ELSE 0 END) AS BIGINT) AS records, CAST(sum(CASE WHEN kind < 2 THEN others ELSE 0 END) AS BIGINT) AS wrong_records
FROM sheets GROUP BY ALL"""


def json_records(spark, sf_dir):
    """Records of arrays, read back."""
    paths = write_lines(event_lines(spark, sf_dir).where("kind = 0"), scratch_path(spark, "json"))
    return read_json_arrays(spark, paths, "file")[0].select("k", "t")


def mixed_files(spark, sf_dir):
    """CSV and JSON files of different columns as one table."""
    sheets = write_lines(order_lines(spark, sf_dir).where("kind = 0"), scratch_path(spark, "mixed-csv"))
    arrays = write_lines(event_lines(spark, sf_dir).where("kind = 0"), scratch_path(spark, "mixed-json"))
    # readers tell formats apart by the name's ending
    merged = read_case_files(spark, [renamed(spark, path, ending) for paths, ending in ((sheets, ".csv"), (arrays, ".json")) for path in paths])
    return merged.agg(
        F.count("*").alias("rows"), F.count("key").alias("orders"), F.count("k").alias("events"), F.count_distinct("_record_id").alias("record_ids"),
        F.count_if(F.col("note").contains("\n")).alias("notes_with_breaks"))


def renamed(spark, path, ending):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    target = hadoop(path + ending)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).rename(hadoop(path), target)
    return path + ending


MIXED_SQL = """SELECT (SELECT count(*) FROM orders WHERE o_orderkey % 7 = 0) + (SELECT count(*) FROM events WHERE event_id % 5 = 0) AS rows,
  (SELECT count(*) FROM orders WHERE o_orderkey % 7 = 0) AS orders, (SELECT count(*) FROM events WHERE event_id % 5 = 0) AS events,
  (SELECT count(*) FROM orders WHERE o_orderkey % 7 = 0) AS record_ids, (SELECT count(*) FROM orders WHERE o_orderkey % 7 = 0) AS notes_with_breaks"""


def cleaned_headers(spark, sf_dir):
    nations = table(spark, sf_dir, "nation")
    untidy = nations.select(*[F.col(name).alias(f"\ufeff {name} ") for name in nations.columns])
    return clean_headers(untidy).select("n_nationkey", "n_name", "n_regionkey")


# -- folders ---------------------------------------------------------------------------------------


def order_years(spark, sf_dir):
    return [row.y for row in year_span(table(spark, sf_dir, "orders"), "o_orderdate").select(F.explode(F.sequence("first", "last")).alias("y")).collect()]


def folder_scan(spark, sf_dir):
    """Monthly totals of orders, a file for each year and version below one root; the newest version of each year is read."""
    layout, orders = Layout(scratch_path(spark, "lake")), table(spark, sf_dir, "orders")
    monthly = orders.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("month")).agg(F.count("*").alias("orders"))
    for year in order_years(spark, sf_dir):
        own = monthly.where(F.col("y") == year).select("month", "orders")
        for version, rows in (("_20200101", own.withColumn("orders", F.lit(-1))), ("_20210101", own), ("", own.limit(1))):
            path = layout.at("raw", "disease", f"year={year + 543}", f"disease_cases_{year + 543}_full{version}.csv")
            files.write_export(rows, path, "csv", single_file=True)
    found = read_cases(spark, layout.raw_cases_glob)
    year = F.regexp_extract("_source_file", r"disease_cases_(\d{4})", 1)
    return found.select(year.alias("year_be"), F.col("month").cast("int").alias("month"), F.col("orders").cast("long").alias("orders"))


def population_scan(spark, sf_dir):
    """A denominator file for each year in one of three encodings, and a file without denominators."""
    layout, (latin, thai) = Layout(scratch_path(spark, "lake")), thai_code_page()
    known = order_population(spark, sf_dir)
    for year in order_years(spark, sf_dir):
        rows = known.where(F.col("year_be") == year + 543).select(
            F.lit(1).alias("ord"), F.concat_ws(",", F.col("year_be").cast("string"), F.concat(F.lit("เขต"), F.col("district_name")), F.col("population").cast("long").cast("string")).alias("value"))
        lines = rows.unionByName(spark.createDataFrame([(0, ("\ufeff" if year % 3 == 1 else "") + "ปี,เขต,ประชากรรวม")], "ord int, value string"))
        if year % 3 == 2:
            lines = lines.withColumn("value", F.encode(F.translate("value", thai, latin), "ISO-8859-1").cast("string"))
        path = layout.at("raw", "population", f"year={year + 543}", f"population_summary_{year + 543}.csv")
        files.write_export(lines.repartition(1).sortWithinPartitions("ord").select("value"), path, "text", single_file=True)
    other = spark.createDataFrame([("a,b",), ("1,2",)], "value string").coalesce(1)
    files.write_export(other, layout.at("raw", "population", "year=1", "population_summary_1.csv"), "text", single_file=True)
    found = read_population(spark, layout.raw_population_glob)
    return found.select(F.col("ปี").alias("year"), F.col("เขต").alias("district"), F.col("ประชากรรวม").alias("population"), "_source_year", "_source_file")


POPULATION_SQL = o.query(o.ORDER_POPULATION, select="""SELECT CAST(year_be AS VARCHAR) AS year, 'เขต' || district_name AS district,
  CAST(CAST(population AS BIGINT) AS VARCHAR) AS population, year_be AS _source_year, 'population_summary_' || year_be || '.csv' AS _source_file FROM known_population""")


def gold_without_population(spark, sf_dir):
    """Gold where the optional denominators are missing: the folder isn't found, and an empty typed table stands for it."""
    cases = order_cases(spark, sf_dir)
    try:
        population = read_population(spark, Layout(scratch_path(spark, "nothing")).raw_population_glob)
    except SourceNotFound:
        population = no_population(cases)
    return gold_table(cases, population, ids_unique=True)


# -- sinks -----------------------------------------------------------------------------------------


def quality_files(spark, sf_dir):
    """The report and the failing rules, read back from their files."""
    folder, found = scratch_path(spark, "report"), order_layers(spark, sf_dir)
    files.write_quality(quality_report(found, SETTINGS, DOMAIN), f"{folder}/quality.csv", f"{folder}/errors.csv")
    both = [spark.read.option("header", "true").option("quote", '"').option("escape", '"').csv(f"{folder}/{name}.csv").withColumn("file", F.lit(name)) for name in ("quality", "errors")]
    return both[0].unionByName(both[1])


QUALITY_FILES_SQL = o.over_orders(
    "SELECT *, 'quality' AS file FROM report UNION ALL SELECT *, 'errors' FROM report WHERE status = 'FAIL'", o.GOLD, o.ORDER_LAYERS, o.quality())


def table_files(spark, sf_dir):
    """All tables of the star as Parquet and as CSV, counted again in both."""
    folder, tables = scratch_path(spark, "tables"), order_star(spark, sf_dir).tables()
    files.write_tables(tables, f"{folder}/parquet", f"{folder}/csv")
    counts = []
    for name in tables:
        counts.append(spark.read.parquet(f"{folder}/parquet/{name}").agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), F.lit("parquet").alias("format"), "rows"))
        counts.append(spark.read.option("header", "true").csv(f"{folder}/csv/{name}.csv").agg(F.count("*").alias("rows")).select(F.lit(name), F.lit("csv"), "rows"))
    out = counts[0]
    for more in counts[1:]:
        out = out.union(more)
    return out


STAR_TABLES = ("dim_date", "dim_district", "dim_disease", "dim_age_group", "dim_sex", "fact_disease_cases", "fact_population")
TABLE_FILES_SQL = o.over_orders("\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{fmt}' AS format, count(*) AS rows FROM {name}" for name in STAR_TABLES for fmt in ("parquet", "csv")))


def kept_export(spark, sf_dir):
    """A reference table that a second export must not replace: what stays, and whether the second one was refused."""
    path, gold = scratch_path(spark, "gold.parquet"), order_gold(spark, sf_dir)
    files.write_export(gold, path, "parquet", overwrite=False)
    try:
        files.write_export(gold.limit(1), path, "parquet", overwrite=False)
        refused = False
    except AnalysisException:
        refused = True
    return spark.read.parquet(path).agg(F.count("*").alias("rows"), F.sum("total_cases").alias("total_cases")).withColumn("refused", F.lit(refused))


def gold_positions(spark, sf_dir):
    """Every row of gold with its place in the order of the export."""
    return positioned(order_gold(spark, sf_dir), ["year_be", "district_name", "disease_name"], scratch_path(spark, "positions"))


def fact_positions(spark, sf_dir):
    fact = order_star(spark, sf_dir).fact_disease_cases
    return files.positioned_export("fact_disease_cases", fact, scratch_path(spark, "positions")).select(*files.EXPORT_ORDER["fact_disease_cases"], "position")


GOLD_OF_ORDERS = (o.ORDER_CASES, o.ORDER_POPULATION, "population AS (SELECT * FROM known_population)", o.GOLD)
FACT_ORDER = ", ".join(files.EXPORT_ORDER["fact_disease_cases"])

QUERIES = {
    "run_population": (run_population, PUBLISH_SQL),
    "run_cases_only": (run_cases_only, CASES_ONLY_SQL),
    "run_gate": (run_gate, GATE_SQL),
    "run_resumed": (run_resumed, RESUMED_SQL),
    "raw_contract_csv_faults": (faulty_csv, FAULTY_CSV_SQL),
    "raw_contract_json_files": (faulty_json, FAULTY_JSON_SQL),
    "src_json_arrays": (json_records, "SELECT CAST(event_id AS VARCHAR) AS k, event_type || ', \"]}' AS t FROM events WHERE event_id % 5 = 0"),
    "src_mixed_files": (mixed_files, MIXED_SQL),
    "src_clean_headers": (cleaned_headers, "SELECT n_nationkey, n_name, n_regionkey FROM nation"),
    "src_folder_scan": (
        folder_scan,
        "SELECT CAST(year(o_orderdate) + 543 AS VARCHAR) AS year_be, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS orders FROM orders GROUP BY ALL"),
    "src_population_scan": (population_scan, POPULATION_SQL),
    "gold_without_population": (
        gold_without_population,
        o.query(o.ORDER_CASES, "population AS (SELECT 0 AS year_be, '' AS district_name, 0.0 AS population WHERE FALSE)", o.GOLD, select="SELECT * FROM gold")),
    "sink_quality_files": (quality_files, QUALITY_FILES_SQL),
    "sink_tables": (table_files, TABLE_FILES_SQL),
    "sink_no_overwrite": (
        kept_export, o.query(*GOLD_OF_ORDERS, select="SELECT count(*) AS rows, CAST(sum(total_cases) AS BIGINT) AS total_cases, TRUE AS refused FROM gold")),
    "so_gold_positions": (
        gold_positions, o.query(*GOLD_OF_ORDERS, select="SELECT *, row_number() OVER (ORDER BY year_be, district_name, disease_name) AS position FROM gold")),
    "so_fact_positions": (fact_positions, o.over_orders(f"SELECT {FACT_ORDER}, row_number() OVER (ORDER BY {FACT_ORDER}) AS position FROM fact_disease_cases")),
}
