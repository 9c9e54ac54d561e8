"""Scalar expressions applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from reconkit.functions import bins, dates, formats, missing, text
from reconkit.queries import Tables, query


@query(
    "is_prefix_either",
    """SELECT p_partkey, starts_with(p_name, p_type) OR starts_with(p_type, p_name) OR starts_with(p_brand, 'Brand#1') OR starts_with('Brand#1', p_brand) AS hit FROM part""",
)
def is_prefix_either(t: Tables):
    hit = text.is_prefix_either(F.col("p_name"), F.col("p_type")) | text.is_prefix_either(F.col("p_brand"), F.lit("Brand#1"))
    return t.part.select("p_partkey", hit.alias("hit"))


@query(
    "ci_compare",
    """SELECT doc_id, lower(text) = lower(upper(text)) AS same, starts_with(lower(text), 'the') AS starts,
       contains(lower(text), 'license') AS has FROM documents""",
)
def ci_compare(t: Tables):
    return t.documents.select(
        "doc_id",
        text.ci_equals(F.col("text"), F.upper("text")).alias("same"),
        text.ci_startswith(F.col("text"), F.lit("The")).alias("starts"),
        text.lower_contains(F.col("text"), "LICENSE").alias("has"),
    )


@query(
    "split_trim_list",
    """SELECT conv_id, turn, len(list_filter(list_transform(string_split(coalesce(text, ''), ','), lambda x: trim(x, ' ')), lambda x: x <> '')) AS parts FROM conversations""",
)
def split_trim_list(t: Tables):
    return t.conversations.select("conv_id", "turn", F.size(text.split_trim_list(F.col("text"), ",")).cast("bigint").alias("parts"))


@query(
    "split_identifier",
    """SELECT page_id, CASE WHEN strpos(url, '.') > 0 THEN substr(url, 1, strpos(url, '.') - 1) ELSE url END AS head,
       CASE WHEN strpos(url, '.') > 0 THEN substr(url, strpos(url, '.') + 1) END AS tail FROM pages""",
)
def split_identifier(t: Tables):
    url = F.col("url")
    return t.pages.select("page_id", text.identifier_schema(url).alias("head"), text.identifier_table(url).alias("tail"))


@query("lower_contains", "SELECT page_id, contains(lower(html), '<table') AS has_table FROM pages")
def lower_contains(t: Tables):
    return t.pages.select("page_id", text.lower_contains(F.col("html"), "<TABLE").alias("has_table"))


@query(
    "fixed_char",
    "SELECT c_custkey, rpad(c_mktsegment, 12, ' ') AS padded, rtrim(rpad(c_mktsegment, 5, ' '), ' ') AS shown FROM customer",
)
def fixed_char(t: Tables):
    seg = F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey", formats.format_char(seg, 12).alias("padded"), formats.fixed_char_display(seg, 5).alias("shown")
    )


@query(
    "format_numeric",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN printf('%.2f', c_acctbal) ELSE '.' END AS fixed,
       CASE WHEN c_acctbal > 0 THEN CAST(CAST(trunc(c_acctbal) AS BIGINT) AS VARCHAR) ELSE '.' END AS whole FROM customer""",
)
def format_numeric(t: Tables):
    x = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))
    return t.customer.select("c_custkey", formats.format_numeric(x, 2).alias("fixed"), formats.format_numeric(x).alias("whole"))


@query(
    "format_char",
    "SELECT doc_id, rpad(lang, 6, ' ') AS lang6, CASE WHEN n_chars > 1000 THEN rpad(source, 3, ' ') ELSE '.' END AS source3 FROM documents",
)
def format_char(t: Tables):
    source = F.when(F.col("n_chars") > 1000, F.col("source"))
    return t.documents.select(
        "doc_id", formats.format_char(F.col("lang"), 6).alias("lang6"), formats.format_char(source, 3).alias("source3")
    )


@query(
    "format_date",
    """SELECT event_id, upper(strftime(ts, '%d%b%Y')) AS d, strftime(ts, '%d%b%Y:%H:%M:%S') AS dt,
       CASE WHEN event_type = 'error' THEN '.' ELSE strftime(ts, '%H:%M:%S') END AS tm FROM events""",
)
def format_date(t: Tables):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        formats.format_date(ts).alias("d"),
        formats.format_datetime(ts).alias("dt"),
        formats.format_time(F.when(F.col("event_type") != "error", ts)).alias("tm"),
    )


@query(
    "informat_numeric",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN NULL ELSE round(value, 2) END AS x FROM events""",
)
def informat_numeric(t: Tables):
    shown = F.when(F.col("event_type") == "error", ".").when(F.col("event_type") == "signup", "n/a").otherwise(
        F.concat(F.lit(" $"), F.format_number("value", 2), F.lit(" "))
    )
    return t.events.select("event_id", formats.informat_numeric(shown).alias("x"))


@query(
    "informat_date",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d, substr(o_orderpriority, 1, 3) AS p FROM orders""",
)
def informat_date(t: Tables):
    shown = F.when(F.col("o_orderstatus") == "P", "31FEB2020").otherwise(formats.format_date(F.col("o_orderdate")))
    return t.orders.select(
        "o_orderkey",
        dates.date_text(formats.informat_date(shown)).alias("d"),
        formats.informat_char(F.col("o_orderpriority"), 3).alias("p"),
    )


@query(
    "sas_date",
    """SELECT o_orderkey, CAST(datediff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days,
       strftime(o_orderdate, '%Y-%m-%d') AS back FROM orders""",
)
def sas_date(t: Tables):
    n = dates.days_since_epoch(F.col("o_orderdate"))
    return t.orders.select("o_orderkey", n.alias("days"), dates.date_text(dates.date_from_days(n)).alias("back"))


@query(
    "sas_datetime",
    """SELECT event_id, round(date_diff('microsecond', TIMESTAMP '1960-01-01', ts) / 1000000.0, 6) AS seconds,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS back FROM events""",
)
def sas_datetime(t: Tables):
    s = dates.seconds_since_epoch(F.col("ts"))
    back = F.date_format(dates.datetime_from_seconds(s), "yyyy-MM-dd HH:mm:ss")
    return t.events.select("event_id", F.round(s, 6).alias("seconds"), back.alias("back"))


@query(
    "sas_time",
    """SELECT event_id, CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS seconds, strftime(ts, '%H:%M:%S') AS back FROM events""",
)
def sas_time(t: Tables):
    s = dates.seconds_of_day(F.col("ts"))
    return t.events.select("event_id", s.alias("seconds"), dates.time_from_seconds(s).alias("back"))


@query(
    "is_missing",
    """SELECT event_id, event_type IN ('error', 'click') AS num_missing, event_type IN ('view', 'signup') AS char_missing FROM events""",
)
def is_missing(t: Tables):
    kind = F.col("event_type")
    x = F.when(kind == "error", F.lit(float("nan"))).when(kind != "click", F.col("value"))
    s = F.when(kind == "view", F.lit("")).when(kind != "signup", kind)
    return t.events.select(
        "event_id",
        F.coalesce(missing.is_missing_numeric(x), F.lit(True)).alias("num_missing"),
        missing.is_missing_char(s).alias("char_missing"),
    )


@query(
    "sas_coalesce",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 'second' WHEN 'signup' THEN 'second' WHEN 'error' THEN 'third' ELSE event_type END AS s,
       CASE WHEN event_type = 'error' THEN value ELSE CAST(user_id AS DOUBLE) END AS x FROM events""",
)
def sas_coalesce(t: Tables):
    kind = F.col("event_type")
    first = F.when(kind == "view", F.lit("")).when(~kind.isin("signup", "error"), kind)
    second = F.when(kind != "error", F.lit("second")).otherwise("")
    x = F.when(kind == "error", F.lit(float("nan"))).otherwise(F.col("user_id").cast("double"))
    return t.events.select(
        "event_id",
        missing.coalesce_text(first, second, F.lit("third")).alias("s"),
        missing.coalesce_numeric(x, F.col("value")).alias("x"),
    )


@query(
    "sas_array",
    """SELECT l_orderkey, l_linenumber, 3 AS dim, CASE l_linenumber % 3 WHEN 0 THEN l_quantity WHEN 1 THEN l_discount ELSE l_tax END AS chosen,
       CAST(0.5 AS DOUBLE) AS l_tax FROM lineitem""",
)
def sas_array(t: Tables):
    group = bins.ColumnArray(["l_quantity", "l_discount", "l_tax"])
    chosen = t.lineitem.withColumns({"chosen": group.get(F.col("l_linenumber") % 3 + 1), "dim": group.dim()})
    return group.set(chosen, 3, F.lit(0.5)).select("l_orderkey", "l_linenumber", "dim", "chosen", "l_tax")


@query(
    "clamp_length",
    """SELECT doc_id, least(n_chars * 40, 32767) AS char_length, greatest(least(n_chars // 100, 8), 3) AS num_length FROM documents""",
)
def clamp_length(t: Tables):
    n = F.col("n_chars")
    return t.documents.select(
        "doc_id",
        formats.clamp_length(n * 40, True).alias("char_length"),
        formats.clamp_length(F.floor(n / 100)).alias("num_length"),
    )


@query(
    "column_label",
    """SELECT 'Order total' AS label, count(o_totalprice) AS n FROM orders""",
)
def column_label(t: Tables):
    labelled = formats.with_labels(t.orders, {"o_totalprice": "Order total"})
    return labelled.agg(F.lit(formats.label_of(labelled, "o_totalprice")).alias("label"), F.count("o_totalprice").alias("n"))


@query(
    "cut_bins",
    """SELECT l_quantity, CASE WHEN l_quantity > 0 AND l_quantity <= 15 THEN 'low' WHEN l_quantity > 15 AND l_quantity <= 30 THEN 'mid'
       WHEN l_quantity > 30 AND l_quantity <= 45 THEN 'high' END AS bin, count(*) AS n FROM lineitem GROUP BY ALL""",
)
def cut_bins(t: Tables):
    bin_ = bins.cut(F.col("l_quantity"), [0, 15, 30, 45], ["low", "mid", "high"])
    return t.lineitem.groupBy("l_quantity", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "where_mask",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0.0 END AS kept, CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_acctbal END AS masked FROM customer""",
)
def where_mask(t: Tables):
    x = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey",
        bins.where(x, x > 0, F.lit(0.0)).alias("kept"),
        bins.mask(x, x > 9000, F.lit(None).cast("double")).alias("masked"),
    )


@query(
    "eval_expression",
    "SELECT l_orderkey, l_linenumber, l_quantity + l_linenumber AS c FROM lineitem WHERE l_quantity > 10 AND l_linenumber < 6",
)
def eval_expression(t: Tables):
    chosen = t.lineitem.filter(F.expr("l_quantity > 10 AND l_linenumber < 6"))
    return chosen.select("l_orderkey", "l_linenumber", F.expr("l_quantity + l_linenumber").alias("c"))


@query(
    "row_product",
    "SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS product, l_quantity * 2 + 1 AS assigned FROM lineitem",
)
def row_product(t: Tables):
    product = t.lineitem.transform(lambda df: df.withColumn("product", F.col("l_quantity") * F.col("l_extendedprice")))
    return product.withColumns({"assigned": F.col("l_quantity") * 2 + 1}).select("l_orderkey", "l_linenumber", "product", "assigned")


@query(
    "md5_key",
    """SELECT o_orderkey, md5('{"o_orderkey":' || o_orderkey || ',"o_orderstatus":' || CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '"' || o_orderstatus || '"' END || '}') AS digest FROM orders""",
)
def md5_key(t: Tables):
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"))
    return o.select("o_orderkey", text.row_digest("o_orderkey", "o_orderstatus").alias("digest"))


@query(
    "date_parts",
    "SELECT strftime(l_shipdate, '%Y') AS year, strftime(l_shipdate, '%m') AS month, count(*) AS n FROM lineitem GROUP BY ALL",
)
def date_parts(t: Tables):
    d = F.col("l_shipdate")
    return t.lineitem.groupBy(dates.year_text(d).alias("year"), dates.month_text(d).alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "date_trunc_month",
    "SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS month, max(l_quantity) AS q FROM lineitem GROUP BY 1",
)
def date_trunc_month(t: Tables):
    month = dates.date_text(F.date_trunc("month", "l_shipdate"))
    return t.lineitem.groupBy(month.alias("month")).agg(F.max("l_quantity").alias("q"))


@query(
    "date_range_days",
    """SELECT user_id, CAST(floor(date_diff('microsecond', min(ts), max(ts)) / 86400000000) AS BIGINT) AS days FROM events GROUP BY 1""",
)
def date_range_days(t: Tables):
    span = t.events.groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return span.select("user_id", dates.whole_days_between(F.col("a"), F.col("b")).alias("days"))


@query(
    "years_between",
    "SELECT o_orderkey, round(datediff('day', CAST(o_orderdate AS DATE), DATE '2024-01-01') / 365.25, 6) AS years FROM orders",
)
def years_between(t: Tables):
    years = dates.years_between(F.lit("2024-01-01").cast("date"), F.col("o_orderdate"))
    return t.orders.select("o_orderkey", F.round(years, 6).alias("years"))


@query(
    "ts_from_parts",
    """SELECT event_id, strftime(make_timestamp(year(ts), month(ts), day(ts), hour(ts), minute(ts), 0.0), '%Y-%m-%d %H:%M:%S') AS built,
       CAST(floor(epoch(ts)) AS BIGINT) AS epoch, strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS back FROM events""",
)
def ts_from_parts(t: Tables):
    ts = F.col("ts")
    built = F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.lit(0))
    epoch = F.unix_timestamp(F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp"))
    show = "yyyy-MM-dd HH:mm:ss"
    return t.events.select(
        "event_id",
        F.date_format(built, show).alias("built"),
        epoch.alias("epoch"),
        F.date_format(F.timestamp_seconds(epoch), show).alias("back"),
    )


@query(
    "ts_add_sub",
    """SELECT event_id, strftime(ts + INTERVAL 36 HOUR - INTERVAL 2 WEEK, '%Y-%m-%d %H:%M:%S') AS moved,
       strftime(TIMESTAMP '2000-01-01' + to_seconds((hour(ts) * 3600 + minute(ts) * 60 + second(ts) + 50000) % 86400), '%H:%M:%S') AS wrapped FROM events""",
)
def ts_add_sub(t: Tables):
    ts = F.col("ts")
    moved = ts + F.make_dt_interval(hours=F.lit(36)) - F.make_dt_interval(days=F.lit(14))
    return t.events.select(
        "event_id",
        F.date_format(moved, "yyyy-MM-dd HH:mm:ss").alias("moved"),
        dates.time_from_seconds(dates.seconds_of_day(ts) + 50000).alias("wrapped"),
    )


@query(
    "ts_compare",
    """SELECT CASE WHEN ts < TIMESTAMP '2024-01-15 12:00:00' THEN 'before' WHEN ts > TIMESTAMP '2024-01-15 12:00:00' THEN 'after' ELSE 'equal' END AS side,
       count(*) AS n FROM events GROUP BY 1""",
)
def ts_compare(t: Tables):
    noon = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    side = F.when(F.col("ts") < noon, "before").when(F.col("ts") > noon, "after").otherwise("equal")
    return t.events.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"))


# January 2024: fixed winter offsets, so the SQL needs no time-zone data.
@query(
    "tz_convert",
    """SELECT event_id, strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS new_york, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS tokyo,
       strftime(ts - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS paris_as_utc, strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS fixed FROM events""",
)
def tz_convert(t: Tables):
    ts, show = F.col("ts"), "yyyy-MM-dd HH:mm:ss"
    return t.events.select(
        "event_id",
        F.date_format(dates.in_zone(ts, "America/New_York"), show).alias("new_york"),
        F.date_format(dates.in_zone(ts, "Asia/Tokyo"), show).alias("tokyo"),
        F.date_format(dates.from_zone(ts, "Europe/Paris"), show).alias("paris_as_utc"),
        F.date_format(dates.in_zone(ts, "+05:30"), show).alias("fixed"),
    )


@query("ts_iso", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM events")
def ts_iso(t: Tables):
    return t.events.select("event_id", dates.iso_text(F.col("ts")).alias("iso"))


@query(
    "date_time_split_join",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS d, strftime(ts, '%H:%M:%S') AS tm, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS joined FROM events""",
)
def date_time_split_join(t: Tables):
    ts = F.col("ts")
    d, s = F.to_date(ts), dates.seconds_of_day(ts)
    joined = F.timestamp_add("SECOND", s, d.cast("timestamp_ntz"))
    return t.events.select(
        "event_id",
        dates.date_text(d).alias("d"),
        dates.time_from_seconds(s).alias("tm"),
        F.date_format(joined, "yyyy-MM-dd HH:mm:ss").alias("joined"),
    )


@query(
    "weekday",
    """SELECT CAST(isodow(l_shipdate) - 1 AS INTEGER) AS weekday, isodow(l_shipdate) >= 6 AS is_weekend, count(*) AS n FROM lineitem GROUP BY ALL""",
)
def weekday(t: Tables):
    d = F.col("l_shipdate")
    return t.lineitem.groupBy(dates.weekday_monday0(d).alias("weekday"), dates.is_weekend(d).alias("is_weekend")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "valid_date",
    """SELECT l_orderkey, l_linenumber, TRY_CAST(printf('%04d-%02d-%02d', CAST(1990 + l_quantity AS INTEGER), CAST(l_linenumber * 2 AS INTEGER), CAST(l_suppkey % 33 AS INTEGER)) AS DATE) IS NOT NULL AS date_ok,
       CAST(l_quantity AS INTEGER) < 24 AND l_partkey % 70 < 60 AS time_ok, CAST(l_quantity AS INTEGER) <= 18 AS zone_ok FROM lineitem""",
)
def valid_date(t: Tables):
    q = F.col("l_quantity").cast("int")
    day = (F.col("l_suppkey") % 33).cast("int")
    zone = F.format_string("+%02d:00", q)
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        dates.is_valid_date(q + 1990, F.col("l_linenumber") * 2, day).alias("date_ok"),
        dates.is_valid_time(q, (F.col("l_partkey") % 70).cast("int"), F.lit(0)).alias("time_ok"),
        dates.is_valid_zone(zone).alias("zone_ok"),
    )
