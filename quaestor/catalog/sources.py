"""Registered queries on filing indexes, HTML, rate windows and stored datasets."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from quaestor.catalog import inputs as src
from quaestor.catalog.dataset import QA_COLS
from quaestor.catalog.scoring import WS
from quaestor.functions import edgar
from quaestor.functions import text as tx
from quaestor.operators import asof
from quaestor.operators import html as hm
from quaestor.operators import rates as ra
from quaestor.schemas import QA_PAIRS
from quaestor.session import scratch_path
from quaestor.sources import datasets as ds
from quaestor.sources import filings as fl
from quaestor.sources import stages as st

PAGES_IN_A_TASK = 100_000  # built from orders, whose rows are a few bytes in their files
QA_STORED = T.StructType([T.StructField("ord", T.LongType()), *QA_PAIRS.fields])


def cik_pad(spark, sf_dir):
    """Customer numbers as they are, with leading zeros, and longer than ten digits."""
    key = F.col("o_custkey").cast("string")
    cik = (F.when(F.col("o_orderkey") % 3 == 0, key).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("000000"), key))
           .otherwise(F.concat(F.lit("12345678901"), key)))
    return (src.table(spark, sf_dir, "orders").select("o_orderkey", cik.alias("cik"))
            .withColumn("padded", edgar.pad_cik(F.col("cik"))))


def _indexes(spark, sf_dir):
    """A filing index as JSON text for every order."""
    key = F.col("o_orderkey").cast("string")
    status = F.when(F.col("o_orderstatus") == "O", "10-K").when(F.col("o_orderstatus") == "F", "10-Q").otherwise("10-K/A")
    last = F.when(F.col("o_orderpriority") == "5-LOW", "8-K").otherwise("10-K")
    recent = F.struct(
        F.array(F.lit("8-K"), status, last).alias("form"),
        F.transform(F.array(F.lit("1"), F.lit("2"), F.lit("3")), lambda i: F.concat(F.lpad(key, 10, "0"), F.lit("-25-00000"), i)).alias("accessionNumber"),
        F.array(F.lit("a.htm"), F.concat(F.lit("b"), key, F.lit(".htm")), F.concat(F.lit("c"), key, F.lit(".html"))).alias("primaryDocument"))
    index = F.to_json(F.struct(F.concat(F.lit("Company "), key).alias("name"), F.struct(recent.alias("recent")).alias("filings")))
    return src.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("cik"), index.alias("submissions"))


def edgar_latest_filing(spark, sf_dir):
    indexes = fl.parse_submissions(_indexes(spark, sf_dir)).drop("submissions")
    return fl.latest_filing(indexes).select("o_orderkey", "cik", "name", "accession", "url")


def cache_filename(spark, sf_dir):
    indexes = fl.parse_submissions(_indexes(spark, sf_dir)).drop("submissions")
    return fl.latest_filing(indexes).where(F.col("accession").isNotNull()).select("o_orderkey", "file_name")


def html_extract_text(spark, sf_dir):
    return hm.html_to_text(src.heavy_table(spark, sf_dir, "pages", "page_id").select("page_id", "html")).select("page_id", "text")


def table_to_markdown(spark, sf_dir):
    """One page per order with a table that has a header, a spanning cell and an empty row."""
    orders = src.heavy_table(spark, sf_dir, "orders", "o_orderkey", PAGES_IN_A_TASK).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    cell = lambda c: F.concat(F.lit("<td> "), F.col(c).cast("string"), F.lit(" </td>"))
    html = F.concat(
        F.lit('<html><body><p>Item</p><table><tr><th>Order</th><th colspan="2">Status &amp; priority</th></tr><tr>'),
        cell("o_orderkey"), cell("o_orderstatus"), cell("o_orderpriority"),
        F.lit("</tr><tr><td> </td><td></td><td></td></tr></table><b>end</b></body></html>"))
    return hm.html_to_text(orders.select("o_orderkey", html.alias("html"))).select("o_orderkey", "text")


def rate_window(spark, sf_dir):
    events = src.table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return ra.trailing_window(events, "ts", rpm=1).select("event_id", "in_window", F.round("wait_seconds", 6).alias("wait_seconds"))


def rate_window_per_client(spark, sf_dir):
    events = src.table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return ra.trailing_window(events, "ts", ("event_type",), rpm=1, seconds=3600).select("event_id", "event_type", "in_window")


def _errors(spark, sf_dir):
    """An error text per event with a code between 420 and 519."""
    code = F.get_json_object("props", "$.k").cast("int") + 420
    return src.table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("HTTP "), code.cast("string"), F.lit(" "), F.col("event_type")).alias("error"))


def asof_orders(spark, sf_dir):
    """The order in force at each event of its customer; orders are dealt over the month of the events by their keys."""
    events = src.table(spark, sf_dir, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    orders = src.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), "o_orderkey", "o_orderstatus", (
        (F.lit(1704067200) + F.col("o_orderkey") * 7919 % 2592000) * 1000000).alias("since"))
    found = asof.asof_join(events, orders, ["user_id"], "at", "since", ["o_orderkey"])
    return found.select("event_id", "user_id", F.col("matched.o_orderkey").alias("order_key"), F.col("matched.o_orderstatus").alias("status"),
                        (F.col("at") - F.col("matched.since")).alias("age"))


def retryable_error(spark, sf_dir):
    return _errors(spark, sf_dir).select("event_id", tx.is_retryable(F.col("error"), "openrouter").alias("openrouter"),
                                         tx.is_retryable(F.col("error"), "gemini").alias("gemini"))


def backoff_schedule(spark, sf_dir):
    return src.table(spark, sf_dir, "events").select("event_id", tx.backoff_seconds(F.col("user_id") % 3).alias("delay"))


def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    ds.write_csv(src.qa_pairs(spark, sf_dir).select(*QA_COLS), path)
    return ds.read_csv(spark, path, QA_STORED)


def csv_inferred(spark, sf_dir):
    """Orders as a file of texts: whole numbers, floats, blanks, mixed cells, truth values, and nothing at all."""
    key, path = F.col("o_orderkey"), scratch_path(spark, "csv")
    price = F.col("o_totalprice").cast("decimal(15,2)").cast("string")
    ds.write_csv(src.table(spark, sf_dir, "orders").select(
        key.cast("string").alias("whole"), price.alias("price"), F.when(key % 7 != 0, key.cast("string")).otherwise("NA").alias("gaps"),
        F.when(key % 9 == 0, F.concat(F.lit("about "), price)).otherwise(price).alias("mixed"), (key % 2 == 0).cast("string").alias("truth"),
        F.when(key % 5 == 0, F.lit("")).otherwise((key % 2 == 0).cast("string")).alias("truth_gaps"), F.lit("").alias("nothing"),
        F.concat(key.cast("string"), F.lit("000000000000000000")).alias("long_number"), F.concat((key % 90).cast("string"), F.lit("e2")).alias("power")), path)
    return ds.read_csv_inferred(spark, path)


def jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    ds.write_jsonl(src.qa_pairs(spark, sf_dir).select(*QA_COLS), path)
    return ds.read_jsonl(spark, path, QA_STORED)


def checkpoint_resume(spark, sf_dir):
    """The second run finds the stored stage and does not build it again."""
    directory = scratch_path(spark, "stages")
    st.run_stage(spark, directory, "generation", lambda: src.qa_pairs(spark, sf_dir).select(*QA_COLS))

    def rebuilt():
        raise AssertionError("the stored stage was not used")

    return st.run_stage(spark, directory, "generation", rebuilt)


QUERIES = {
    "cik_pad": cik_pad, "edgar_latest_filing": edgar_latest_filing, "cache_filename": cache_filename,
    "html_extract_text": html_extract_text, "table_to_markdown": table_to_markdown, "rate_window": rate_window,
    "rate_window_per_client": rate_window_per_client, "asof_orders": asof_orders, "retryable_error": retryable_error,
    "backoff_schedule": backoff_schedule, "csv_roundtrip": csv_roundtrip, "csv_inferred": csv_inferred, "jsonl_roundtrip": jsonl_roundtrip,
    "checkpoint_resume": checkpoint_resume,
}

PAD = "CASE WHEN length(ltrim({0}, '0')) >= 10 THEN ltrim({0}, '0') ELSE lpad(ltrim({0}, '0'), 10, '0') END"
_HIT = """v_hit AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cik, 'Company ' || o_orderkey AS name,
  CASE WHEN o_orderstatus = 'O' THEN 2 WHEN o_orderpriority <> '5-LOW' THEN 3 END AS k FROM orders),
v_found AS (SELECT *, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '-25-00000' || k AS accession,
  CASE k WHEN 2 THEN 'b' || o_orderkey || '.htm' WHEN 3 THEN 'c' || o_orderkey || '.html' END AS document FROM v_hit)"""
_QA_ALL = src.with_ctes(src.QA_SQL, body=f"SELECT {', '.join(QA_COLS)} FROM v_qa")


def _stripped(expr: str) -> str:
    for pattern, by in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;?", "&"), (rf"\A{WS}+|{WS}+\z", "")):
        expr = f"regexp_replace({expr}, '{pattern}', '{by}', 'g')"
    return expr



def _rate_sql(partition: str, micros: int) -> str:
    frame = f"{partition} ORDER BY us RANGE BETWEEN {micros - 1} PRECEDING AND CURRENT ROW"
    return f"SELECT *, count(*) OVER ({frame}) AS in_window, min(us) OVER ({frame}) AS oldest FROM (SELECT *, epoch_us(ts) AS us FROM events)"


ORACLE = {
    "asof_orders": """SELECT event_id, e.user_id, o_orderkey AS order_key, o_orderstatus AS status, epoch_us(ts) - since AS age
FROM events e ASOF LEFT JOIN (SELECT o_custkey AS user_id, o_orderkey, o_orderstatus, (1704067200 + o_orderkey * 7919 % 2592000) * 1000000 AS since FROM orders) o
  ON e.user_id = o.user_id AND epoch_us(e.ts) >= o.since""",
    "cik_pad": f"""SELECT o_orderkey, cik, {PAD.format('cik')} AS padded FROM (SELECT o_orderkey,
  CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '000000' ELSE '12345678901' END || o_custkey AS cik FROM orders)""",
    "edgar_latest_filing": f"WITH {_HIT} SELECT o_orderkey, cik, name, accession, 'https://www.sec.gov/Archives/edgar/data/' || {PAD.format('cik')} || '/' || replace(accession, '-', '') || '/' || document AS url FROM v_found",
    "cache_filename": f"WITH {_HIT} SELECT o_orderkey, '10k_' || cik || '_' || accession || CASE k WHEN 2 THEN '.htm' ELSE '.html' END AS file_name FROM v_found WHERE k IS NOT NULL",
    "html_extract_text": rf"""SELECT page_id, coalesce(list_aggregate(list_transform(list_filter(list_transform(
  regexp_split_to_array(regexp_replace(regexp_extract(html, '(?is)<body[^>]*>(.*)', 1), '(?is)</body>.*|<script.*?</script>|<style.*?</style>', '', 'g'), '(?s)<!--|-->|<[a-zA-Z/][^>]*>'),
  lambda p: {_stripped('p')}), lambda p: p <> ''), lambda p: p || ' '), 'string_agg', ''), '') AS text FROM pages""",
    "table_to_markdown": """SELECT o_orderkey, concat('Item ', chr(10), chr(10), '| Order | Status & priority |  |', chr(10), '|---|---|---|', chr(10),
  '| ', o_orderkey, ' | ', o_orderstatus, ' | ', o_orderpriority, ' |', chr(10), chr(10), 'end ') AS text FROM orders""",
    "rate_window": f"SELECT event_id, in_window, round(CASE WHEN in_window > 1 THEN 61 - (us - oldest) / 1000000.0 ELSE 0 END::DOUBLE, 6) AS wait_seconds FROM ({_rate_sql('', 60_000_000)})",
    "rate_window_per_client": f"SELECT event_id, event_type, in_window FROM ({_rate_sql('PARTITION BY event_type', 3_600_000_000)})",
    "retryable_error": r"""SELECT event_id, regexp_matches(e, '429|500|503|rate_limit|overloaded|timeout') AS openrouter, regexp_matches(e, '429|500|503|RESOURCE_EXHAUSTED') AS gemini
FROM (SELECT event_id, 'HTTP ' || (CAST(regexp_extract(props, '"k": ?(\d+)', 1) AS INTEGER) + 420) || ' ' || event_type AS e FROM events)""",
    "backoff_schedule": "SELECT event_id, CAST(10 * pow(2, user_id % 3) AS INTEGER) AS delay FROM events",
    "csv_inferred": """SELECT o_orderkey AS whole, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) AS price,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS DOUBLE) END AS gaps,
  CASE WHEN o_orderkey % 9 = 0 THEN 'about ' ELSE '' END || CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS mixed, o_orderkey % 2 = 0 AS truth,
  CASE WHEN o_orderkey % 5 <> 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END END AS truth_gaps, CAST(NULL AS DOUBLE) AS nothing,
  o_orderkey || '000000000000000000' AS long_number, CAST(o_orderkey % 90 * 100 AS DOUBLE) AS power FROM orders""",
    "csv_roundtrip": _QA_ALL, "jsonl_roundtrip": _QA_ALL, "checkpoint_resume": _QA_ALL,
}
