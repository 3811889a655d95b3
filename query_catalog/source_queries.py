"""Source readers and normalizers, fed with inputs that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from contextlake.operators import rollups
from contextlake.schemas import BUS, ENVELOPE, INVENTORY_EVENT, ORDER_EVENT, PAYMENT_EVENT, RUNTIME_LOG
from contextlake.session import work_dir
from contextlake.sources import bus as bus_source
from contextlake.plans import inbox as inbox_plan
from contextlake.sources import csv_records, files, inbox, observations, tables
from contextlake.streaming import jobs

from .adapters import AS_OF, table, view
from .projection_queries import bus
from .registry import half_up, query


def stored(df, name: str, fmt: str = "parquet", **options) -> str:
    """Write a derived input to the shared work folder and return its path."""
    path = work_dir(df.sparkSession, name)
    df.write.options(**options).format(fmt).save(path)
    return path


BUS_COUNTS = """SELECT event_type AS topic, count(*) AS records, max(event_id) AS last_offset FROM events GROUP BY event_type"""


@query("s01_bus_stream", BUS_COUNTS)
def _(spark, sf):
    """All topics through the streaming reader; the files stand in for the bus."""
    source = stored(bus(spark, sf), "bus")
    stream = bus_source.read_file_stream(spark, source, BUS)
    sink, checkpoint = work_dir(spark, "bus-sink"), work_dir(spark, "bus-checkpoint")
    jobs.write_bounded(stream, sink, checkpoint)
    return spark.read.parquet(sink).groupBy("topic").agg(
        rollups.rows("records"), F.max("offset").alias("last_offset")
    )


@query(
    "s02_single_topic_stream",
    "SELECT count(*) AS records, max(event_id) AS last_offset FROM events WHERE event_type = 'purchase'",
)
def _(spark, sf):
    source = stored(bus(spark, sf), "cdc-bus")
    stream = bus_source.read_file_stream(spark, source, BUS, max_files_per_trigger=2)
    sink, checkpoint = work_dir(spark, "cdc-sink"), work_dir(spark, "cdc-checkpoint")
    jobs.write_bounded(stream.filter(F.col("topic") == "purchase"), sink, checkpoint)
    return spark.read.parquet(sink).agg(rollups.rows("records"), F.max("offset").alias("last_offset"))


@query("s03_bounded_bus_read", BUS_COUNTS)
def _(spark, sf):
    return bus(spark, sf).groupBy("topic").agg(rollups.rows("records"), F.max("offset").alias("last_offset"))


@query(
    "s04_bus_metadata",
    """SELECT CAST(user_id AS VARCHAR) AS "key", event_type AS topic, user_id % 3 AS "partition", event_id AS "offset",
    CASE WHEN event_id % 10 <> 0 THEN 5 + length(props) WHEN event_id % 40 = 10 THEN 1 WHEN event_id % 40 = 20 THEN 5 + length(props)
    WHEN event_id % 40 = 30 THEN NULL ELSE 11 END AS value_size FROM events""",
    text=("value_size",),
)
def _(spark, sf):
    return bus_source.bus_metadata(bus(spark, sf))


def typed_bus(spark, sf):
    """Orders, payments and stock changes as JSON bus records."""
    record = lambda source, payload: F.struct(
        F.lit(source).alias("event_source"), F.to_json(payload).alias("json_payload")
    )
    orders = table(spark, sf, "orders")
    ms = lambda c: (F.unix_micros(F.col(c).cast("timestamp")) / 1000).cast("bigint")
    text = lambda c: F.col(c).cast("string")
    order = F.struct(
        text("o_orderkey").alias("order_id"), text("o_custkey").alias("user_id"), F.lit("p").alias("product_id"),
        F.col("o_totalprice").alias("amount"), F.lit("USD").alias("currency"), ms("o_orderdate").alias("ts"),
    )
    payment = F.struct(
        F.concat(F.lit("pay_"), "o_orderkey").alias("payment_id"), text("o_orderkey").alias("order_id"),
        F.lit("CARD").alias("method"), F.col("o_orderstatus").alias("status"), ms("o_orderdate").alias("ts"),
    )
    lines = table(spark, sf, "lineitem")
    change = F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("change_id"), text("l_suppkey").alias("warehouse_id"),
        text("l_partkey").alias("product_id"), F.lit("SALE").alias("change_type"),
        (-F.col("l_quantity")).cast("int").alias("quantity_delta"), F.lit(0).alias("previous_qty"), F.lit(0).alias("new_qty"),
        text("l_orderkey").alias("order_id"), ms("l_shipdate").alias("ts"),
    )
    both = orders.select(F.explode(F.array(record("orders", order), record("payments", payment))).alias("r"))
    return both.unionByName(lines.select(record("inventory", change).alias("r"))).select("r.*")


@query(
    "s05_typed_streams",
    """SELECT 'orders' AS topic, count(*) AS records, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total,
    min(CAST(o_orderdate AS TIMESTAMP)) AS first_time FROM orders
    UNION ALL SELECT 'payments', count(*), CAST(count(DISTINCT o_orderstatus) AS DOUBLE), min(CAST(o_orderdate AS TIMESTAMP)) FROM orders
    UNION ALL SELECT 'inventory', count(*), CAST(-sum(l_quantity) AS DOUBLE), min(CAST(l_shipdate AS TIMESTAMP)) FROM lineitem""",
)
def _(spark, sf):
    """Three typed sinks fed by one bus stream."""
    records = typed_bus(spark, sf)
    source = stored(records, "typed-bus")
    sinks = {}
    for topic, schema, mapping in (
        ("orders", ORDER_EVENT, jobs.order_mapping()),
        ("payments", PAYMENT_EVENT, jobs.payment_mapping()),
        ("inventory", INVENTORY_EVENT, jobs.inventory_mapping()),
    ):
        stream = bus_source.read_file_stream(spark, source, records.schema)
        typed = jobs.typed_stream(stream, topic, schema, mapping)
        sinks[topic] = work_dir(spark, f"typed-{topic}")
        jobs.write_bounded(typed, sinks[topic], work_dir(spark, f"typed-{topic}-checkpoint"))
    read = lambda topic: spark.read.parquet(sinks[topic])
    summary = lambda topic, total: read(topic).agg(
        rollups.rows("records"), total.cast("double").alias("total"), F.min("event_time").alias("first_time")
    ).select(F.lit(topic).alias("topic"), "*")
    return (
        summary("orders", F.sum("amount"))
        .unionByName(summary("payments", F.countDistinct("payment_status")))
        .unionByName(summary("inventory", F.sum("quantity_delta")))
    )


def landing_events(spark, sf):
    """Weather and signal envelopes, the input of the landing queries."""
    from contextlake.operators.envelope import SIGNAL, WEATHER, envelope

    weather = view(spark, sf, "v_weather").dropDuplicates(["location_id", "forecast_time", "fetched_at"])
    return envelope(view(spark, sf, "v_signals"), SIGNAL, AS_OF).unionByName(envelope(weather, WEATHER, AS_OF))


@query(
    "s06_landing_read",
    """SELECT 'context_signals' AS source_name, count(*) AS events, count(DISTINCT signal_id) AS ids,
    CAST(sum(urgency) AS DOUBLE) AS payload_sum FROM v_signals
    UNION ALL SELECT 'weather_forecast', count(*), count(*), CAST(sum(visibility_m) AS DOUBLE)
    FROM (SELECT DISTINCT location_id, forecast_time, visibility_m FROM v_weather)""",
    ("v_signals", "v_weather"),
)
def _(spark, sf):
    from contextlake.sinks.tables import write_landing

    root = work_dir(spark, "landing")
    write_landing(landing_events(spark, sf), root, "2024-01-31", compression="gzip")
    landing = files.read_landing(spark, f"{root}/*/dt=*/*")
    number = F.coalesce(
        F.get_json_object("payload", "$.urgency"), F.get_json_object("payload", "$.visibility_m")
    ).cast("double")
    return landing.groupBy("source_name").agg(
        rollups.rows("events"), F.countDistinct("event_id").alias("ids"), F.sum(number).alias("payload_sum")
    )


@query(
    "s07_lenient_json_lines",
    """SELECT component, count(*) AS kept FROM v_logs WHERE event_id % 20 <> 0 AND status = 'ok' GROUP BY component""",
    ("v_logs",),
)
def _(spark, sf):
    """Every 20th line is cut in the middle and must be skipped."""
    logs = view(spark, sf, "v_logs")
    good = F.to_json(F.struct("event_time", "component", "action", "status", "message"))
    lines = logs.select(
        F.when(F.col("event_id") % 20 == 0, F.substring(good, F.lit(1), F.length(good) - 3)).otherwise(good).alias("value")
    )
    path = stored(lines, "logs", "text")
    rows = files.read_jsonl_lenient(spark, path, RUNTIME_LOG, {"status": "ok"})
    return rows.groupBy("component").agg(rollups.rows("kept"))


def documents_of_rows(spark, sf):
    """One JSON document per event user: a list, a keyed object or a single object."""
    row = F.to_json(F.struct("event_id", "event_type"))
    return table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("["), row, F.lit(", 7, "), row, F.lit("]")))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit('{"version": 1, "items": ['), row, F.lit("]}")))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit('{"events": ['), row, F.lit(","), row, F.lit("]}")))
        .otherwise(row)
        .alias("text"),
    )


@query(
    "s08_rows_of_json_documents",
    """SELECT event_id, CAST(n AS BIGINT) AS row_number, NOT (event_id % 4 = 0 AND n = 2) AS is_object,
    CASE WHEN event_id % 4 = 0 AND n = 2 THEN NULL ELSE event_type END AS event_type
    FROM events, generate_series(1, 3) g(n)
    WHERE n <= CASE event_id % 4 WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 1 END""",
)
def _(spark, sf):
    rows = files.explode_json_rows(documents_of_rows(spark, sf), "text")
    return rows.select("event_id", "row_number", "is_object", F.get_json_object("row_json", "$.event_type").alias("event_type"))


@query(
    "s09_csv_rows",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id FROM events""",
)
def _(spark, sf):
    path = stored(table(spark, sf, "events").select("event_id", "event_type", "user_id"), "csv", "csv", header=True)
    return files.read_csv_rows(spark, path)


@query(
    "s10_markdown_notes",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'Note ' || event_id ELSE 'Heading ' || event_id END AS title,
    CASE WHEN event_id % 2 = 0 THEN event_type ELSE NULL END AS mood,
    CASE WHEN event_id % 2 = 0 THEN 'body of ' || event_id ELSE '# Heading ' || event_id || chr(10) || 'body: ' || event_type END AS summary
    FROM events""",
)
def _(spark, sf):
    e = F.col("event_id").cast("string")
    with_meta = F.concat(
        F.lit("---\ntitle: Note "), e, F.lit("\nmood: "), "event_type", F.lit("\nno value here\n---\nbody of "), e
    )
    plain = F.concat(F.lit("# Heading "), e, F.lit("\nbody: "), "event_type")
    notes = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 2 == 0, with_meta).otherwise(plain).alias("text")
    )
    return files.parse_notes(notes).select("event_id", "title", "mood", "summary")


@query(
    "s11_calendar_blocks",
    """SELECT event_id, CAST(1 AS BIGINT) AS block_number, date_trunc('second', ts) AS started_at,
    date_trunc('second', ts) + INTERVAL 45 MINUTE AS ended_at, CAST(45 AS BIGINT) AS duration_minutes, false AS all_day,
    substring(sha256('Standup, part two ' || event_type), 1, 16) AS summary_hash, 'work' AS summary_category,
    event_id % 2 = 0 AS location_present, event_id % 3 AS attendee_count, 'tentative' AS status FROM events
    UNION ALL SELECT event_id, 2, CAST(CAST(ts AS DATE) AS TIMESTAMP), CAST(CAST(ts AS DATE) AS TIMESTAMP), 0, true,
    '', 'personal', false, 0, 'confirmed' FROM events""",
)
def _(spark, sf):
    """Two events per calendar; folded lines, zoned keys and a date-only start."""
    at = lambda c: F.date_format(c, "yyyyMMdd'T'HHmmss'Z'")
    location = F.when(F.col("event_id") % 2 == 0, F.lit("LOCATION:Room 4\r\n")).otherwise("")
    attendees = F.repeat(F.lit("ATTENDEE;ROLE=REQ:mailto:x\r\n"), (F.col("event_id") % 3).cast("int"))
    text = F.concat(
        F.lit("BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nDTSTART;TZID=UTC:"), at("ts"), F.lit("\r\nDTEND:"),
        at(F.col("ts") + F.expr("INTERVAL 45 MINUTES")), F.lit("\r\nSUMMARY:Standup, part\r\n  two "), "event_type",
        F.lit("\r\n"), location, attendees,
        F.lit("STATUS:TENTATIVE\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nDTSTART:"), F.date_format("ts", "yyyyMMdd"),
        F.lit("\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nDTSTART:20240101\r\nEND:VCALENDAR"),
    )
    blocks = files.calendar_blocks(table(spark, sf, "events").select("event_id", text.alias("text")), path=None)
    return blocks.select(
        "event_id", "block_number", "started_at", "ended_at", "duration_minutes", "all_day", "summary_hash",
        "summary_category", "location_present", "attendee_count", "status",
    )


@query(
    "s12_track_points",
    """SELECT event_id, CAST(n AS BIGINT) AS idx, CAST(event_id % 90 AS DOUBLE) + CAST(n AS DOUBLE) / 10 AS lat, CAST(user_id AS DOUBLE) AS lon,
    CASE WHEN n = 0 THEN CAST(event_id % 7 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS ele,
    CASE WHEN n = 0 THEN event_type ELSE '' END AS "time" FROM events, generate_series(0, 1) g(n)""",
)
def _(spark, sf):
    e = F.col("event_id")
    lat = lambda n: (e % 90).cast("double") + n / 10
    text = F.concat(
        F.lit('<gpx xmlns="http://x"><trk><trkseg><trkpt lat="'), lat(0), F.lit('" lon="'), "user_id",
        F.lit('"><ele>'), (e % 7), F.lit("</ele><time>"), "event_type", F.lit("</time></trkpt>\n<trkpt lon='"), "user_id",
        F.lit("' lat='"), lat(1), F.lit("'/></trkseg></trk></gpx>"),
    )
    return files.track_points(table(spark, sf, "events").select("event_id", text.alias("text")))


@query(
    "s13_feed_items",
    """SELECT event_id, CAST(n AS BIGINT) AS item_number, CASE WHEN event_id % 2 = 0 THEN 'R & ' ELSE 'A ' END || event_type || ' ' || n AS title,
    'https://example.com/' || event_id || '/' || n AS url, date_trunc('second', ts) AS published_time,
    CASE WHEN event_id % 2 = 0 THEN 'about ' || n ELSE '' END AS summary FROM events, generate_series(1, 2) g(n)""",
)
def _(spark, sf):
    link = lambda n: F.concat(F.lit("https://example.com/"), "event_id", F.lit(f"/{n}"))
    rss = lambda n: F.concat(
        F.lit("<item><title><![CDATA[R & "), "event_type", F.lit(f" {n}]]></title><link>"), link(n),
        F.lit("</link><pubDate>"), F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"),
        F.lit(f"</pubDate><description>about {n}</description></item>"),
    )
    atom = lambda n: F.concat(
        F.lit("<entry><title>A "), "event_type", F.lit(f" {n}</title><link href=\""), link(n),
        F.lit("\"/><updated>"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</updated></entry>"),
    )
    text = F.when(
        F.col("event_id") % 2 == 0, F.concat(F.lit("<rss><channel>"), rss(1), rss(2), F.lit("</channel></rss>"))
    ).otherwise(F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), atom(1), atom(2), F.lit("</feed>")))
    items = files.feed_items(table(spark, sf, "events").select("event_id", "ts", text.alias("text")))
    return items.select("event_id", "item_number", "title", "url", "published_time", "summary")


@query(
    "s14_weather_series",
    """SELECT 'loc_' || event_id AS location_id, date_trunc('second', ts) + n * INTERVAL 1 HOUR AS forecast_time,
    CASE WHEN n = 0 THEN value WHEN n = 1 THEN CAST(0 AS DOUBLE) ELSE CAST(-1.5 AS DOUBLE) END AS temperature_c,
    CASE WHEN n = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS rain_mm, CAST(10000 AS DOUBLE) AS visibility_m,
    n <> 1 AS is_day FROM events, generate_series(0, 2) g(n)""",
)
def _(spark, sf):
    """Three hours per payload: a null, a short array and missing arrays take defaults."""
    hours = F.array(
        *[F.date_format(F.col("ts") + F.expr(f"INTERVAL {n} HOURS"), "yyyy-MM-dd'T'HH:mm:ss") for n in range(3)]
    )
    payload = F.concat(
        F.lit('{"hourly": {"time": '), F.to_json(hours), F.lit(', "temperature_2m": ['), "value",
        F.lit(', null, -1.5], "rain": [0.5], "is_day": [1, 0, 1]}}'),
    )
    payloads = table(spark, sf, "events").select(
        F.concat(F.lit("loc_"), "event_id").alias("location_id"), payload.alias("payload"), F.col("ts").alias("fetched_at")
    )
    rows = observations.normalize_weather(payloads, "payload")
    return rows.select("location_id", "forecast_time", "temperature_c", "rain_mm", "visibility_m", "is_day")


@query(
    "s15_places",
    """WITH seen AS (SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id)
    SELECT 'osm_node_' || e.user_id AS spot_id, CASE WHEN e.event_id % 2 = 0 THEN 'Spot ' || e.event_id ELSE 'park' END AS label,
    CAST(e.user_id AS DOUBLE) / 10 AS latitude, CAST(e.event_id AS DOUBLE) / 10 AS longitude,
    'public|skateboard|park|skate' AS tags, 'overpass' AS source FROM events e JOIN seen USING (event_id)""",
)
def _(spark, sf):
    """Every user id is one map element, repeated in many payloads; elements without a position are dropped."""
    name = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('"name": "Spot '), "event_id", F.lit('", '))).otherwise("")
    payload = F.concat(
        F.lit('{"elements": [{"type": "way", "id": 1}, {"type": "node", "id": '), "user_id",
        F.lit(', "center": {"lat": '), F.col("user_id") / 10, F.lit(', "lon": '), F.col("event_id") / 10,
        F.lit('}, "tags": {'), name, F.lit('"sport": "skateboard", "leisure": "park"}}]}'),
    )
    payloads = table(spark, sf, "events").select("event_id", payload.alias("payload"))
    return observations.normalize_places(payloads, "payload", [F.col("event_id")])


@query(
    "s16_cdc_current_state",
    """SELECT user_id, event_id AS version, event_type AS status FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1 AND event_type <> 'error'""",
)
def _(spark, sf):
    """Change records per user: 'error' deletes the row, everything else writes it."""
    image = F.struct("user_id", F.col("event_id").alias("version"), F.col("event_type").alias("status"))
    gone = F.col("event_type") == "error"
    record = F.struct(
        F.when(gone, image).alias("before"),
        F.when(~gone, image).alias("after"),
        F.struct(F.col("event_id").alias("lsn"), F.lit("users").alias("table")).alias("source"),
        F.when(gone, "d").when(F.col("event_id") % 2 == 0, "u").otherwise("c").alias("op"),
    )
    records = table(spark, sf, "events").select(F.to_json(record).alias("json_payload"))
    changes = bus_source.parse_cdc(records, "struct<user_id:bigint,version:bigint,status:string>")
    return bus_source.cdc_current_state(changes, ["user_id"])


@query(
    "s17_federated_counts",
    """SELECT n.n_name AS nation, count(DISTINCT c.c_custkey) AS customers, count(o.o_orderkey) AS orders
    FROM nation n LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY 1""",
)
def _(spark, sf):
    """Tables of three stores under one namespace, joined in SQL."""
    tables.register_tables(
        spark,
        {"nation": table(spark, sf, "nation"), "customer": table(spark, sf, "customer"), "orders": table(spark, sf, "orders")},
        prefix="fed_",
    )
    return spark.sql(
        """SELECT n.n_name AS nation, count(c.c_custkey) AS customers, coalesce(sum(o.orders), 0) AS orders
        FROM fed_nation n LEFT JOIN fed_customer c ON c.c_nationkey = n.n_nationkey
        LEFT JOIN (SELECT o_custkey, count(*) AS orders FROM fed_orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey
        GROUP BY n.n_name"""
    )


@query("s18_table_by_name", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def _(spark, sf):
    by_path = tables.read_table(spark, f"{sf}/supplier.parquet")
    by_path.createOrReplaceTempView("supplier_by_name")
    return tables.read_table(spark, "supplier_by_name").select("s_suppkey", "s_name", "s_nationkey")


FILES = (
    "sleep_2024.json", "moto.csv", "calendar.ics", "note.md", "my_journal.csv", "area.json", "finance_event.json",
    "health_metrics.json", "export.json", "data.json", "photo.png", "weekly_summary.csv",
)
KINDS = (
    "sleep", "moto_learning", "ics", "personal_notes", "trade_journal", "location_area_summary",
    "finance_event_calendar", "health_metrics", "habit_goals", "", "", "personal_notes",
)


@query(
    "s19_detected_kinds",
    f"""SELECT event_id, CASE CAST(event_id % 12 AS INT) {' '.join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS))} END AS kind FROM events""",
)
def _(spark, sf):
    """Kinds by name, and by keys where the name decides nothing."""
    names = F.array(*[F.lit(f) for f in FILES])
    path = F.concat(F.lit("inbox/"), F.col("event_id"), F.lit("/"), F.get(names, (F.col("event_id") % 12).cast("int")))
    text = F.when(
        F.col("event_id") % 12 == 8,
        F.concat(F.lit('{"rows": [{"goal_bucket": "g", "Target_Count": 3, "done_count": '), "user_id", F.lit("}]}")),
    ).otherwise(F.col("props"))
    listed = table(spark, sf, "events").select("event_id", path.alias("path"), text.alias("text"))
    return inbox.with_kind(listed).select("event_id", "kind")


@query(
    "s20_subscription_items",
    """SELECT 'sub_' || event_id AS subscription_id, CAST(n AS BIGINT) AS item_number,
    CASE event_id % 3 WHEN 0 THEN 'Feed ' || n WHEN 1 THEN 'Record ' || n ELSE 'Label ' || event_id END AS title,
    CASE WHEN event_id % 3 = 2 THEN 'source_seen' END AS event_type
    FROM events, generate_series(1, 3) g(n) WHERE event_id % 5 <> 0 AND n <= CASE event_id % 3 WHEN 2 THEN 1 ELSE 2 END""",
)
def _(spark, sf):
    """Three items per content, limit two; every fifth subscription is disabled."""
    from contextlake.operators.subscriptions import subscription_items

    subscriptions, contents = managed_sources(spark, sf)
    items = subscription_items(subscriptions, contents, limit=2, checked_at=AS_OF)
    return items.select("subscription_id", "item_number", "title", "event_type")


def managed_sources(spark, sf):
    """Subscriptions derived from events and the contents they would return."""
    e = F.col("event_id")
    kind = F.when(e % 3 == 0, "rss_feed").when(e % 3 == 1, "api_json").otherwise("news_url")
    rss = F.concat(
        F.lit("<rss>"),
        *[
            F.concat(F.lit(f"<item><title>Feed {n}</title><link>https://x.org/"), "event_id", F.lit(f"/{n}</link></item>"))
            for n in (1, 2, 3)
        ],
        F.lit("</rss>"),
    )
    records = F.concat(
        F.lit('{"entries": ['),
        F.concat_ws(
            ", ",
            *[
                F.concat(F.lit(f'{{"name": "Record {n}", "published_at": "'), F.col("ts").cast("string"), F.lit('"}'))
                for n in (1, 2, 3)
            ],
        ),
        F.lit("]}"),
    )
    base = table(spark, sf, "events").select(
        F.concat(F.lit("sub_"), "event_id").alias("subscription_id"),
        kind.alias("source_type"),
        F.concat(F.lit("https://Host.example/"), "event_type").alias("reference"),
        F.concat(F.lit("Label "), "event_id").alias("label"),
        F.lit("news").alias("domain"),
        F.array("event_type").alias("tags"),
        (e % 5 != 0).alias("enabled"),
        F.lit("public_context").alias("privacy_class"),
        F.when(e % 3 == 0, rss).when(e % 3 == 1, records).alias("text"),
    )
    return base.drop("text"), base.filter("text IS NOT NULL").select("subscription_id", "text")


@query(
    "w08_csv_record_numbers",
    """SELECT event_id, user_id % 4 AS part, row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS row_number,
    event_type, round(value, 2) AS value FROM events""",
)
def _(spark, sf):
    """Records of four CSV files read in splits of a few KB: numbers are those of the whole file."""
    root = work_dir(spark, "w08-csv")
    rows = table(spark, sf, "events").select(
        (F.col("user_id") % 4).alias("part"), "event_id", F.concat(F.lit('a, "quoted" '), "event_type").alias("what"),
        F.round("value", 2).alias("value"),
    )
    (
        rows.repartition(4, "part").sortWithinPartitions("part", "event_id")
        .write.partitionBy("part").option("header", True).option("escape", '"').csv(root)
    )
    fine = spark.newSession()
    fine.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    fine.conf.set("spark.sql.files.openCostInBytes", "0")
    numbered = work_dir(spark, "w08-numbered")
    csv_records.csv_records(fine, root).write.parquet(numbered)
    record = F.from_json("row_json", "event_id string, what string, value string")
    found = spark.read.parquet(numbered).withColumn("r", record)
    return found.select(
        F.col("r.event_id").cast("long").alias("event_id"),
        F.regexp_extract("file", "part=([0-9]+)", 1).cast("long").alias("part"),
        "row_number",
        F.regexp_replace("r.what", '^a, "quoted" ', "").alias("event_type"),
        F.col("r.value").cast("double").alias("value"),
    )


@query(
    "s19_inbox_to_envelopes",
    """WITH trades AS (SELECT *, row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS place, event_id % 7 <> 0 AS good FROM events),
    sessions AS (SELECT *, row_number() OVER (PARTITION BY event_id // 500 ORDER BY event_id) AS place, event_id % 5 <> 0 AS good FROM events),
    blocks AS (SELECT *, row_number() OVER (PARTITION BY event_id // 800 ORDER BY event_id) AS place FROM events),
    nights AS (SELECT *, row_number() OVER (PARTITION BY event_id // 600 ORDER BY event_id) AS place, event_id % 9 <> 0 AS good FROM events)
    SELECT 'trade_journal_summary' AS source_name, count(*) FILTER (good) AS n, count(*) FILTER (good) AS n_ids,
           count(*) FILTER (NOT good) AS rejected, CAST(sum(place) FILTER (good) AS BIGINT) AS places,
           CAST(sum(place) FILTER (NOT good) AS BIGINT) AS rejected_places, count(DISTINCT event_type) AS labels FROM trades
    UNION ALL SELECT 'training_sessions', count(*) FILTER (good), count(*) FILTER (good), count(*) FILTER (NOT good),
           CAST(sum(place) FILTER (good) AS BIGINT), CAST(sum(place) FILTER (NOT good) AS BIGINT), count(DISTINCT event_type) FILTER (good) FROM sessions
    UNION ALL SELECT 'sleep_quality', count(*) FILTER (good), count(*) FILTER (good), count(*) FILTER (NOT good),
           CAST(sum(place) FILTER (good) AS BIGINT), CAST(sum(place) FILTER (NOT good) AS BIGINT), 1 FROM nights
    UNION ALL SELECT 'calendar_events', count(*), count(*), 0, CAST(sum(place) AS BIGINT), 0, 1 FROM blocks
    UNION ALL SELECT 'personal_notes_summary', count(DISTINCT event_type), count(DISTINCT event_type), 0, count(DISTINCT event_type), 0,
           count(DISTINCT event_type) FROM events""",
)
def _(spark, sf):
    """CSV, JSON, note and calendar files of one folder, listed, parsed by kind and landed; rejected rows keep their number."""
    e, root = F.col("event_id"), work_dir(spark, "s19-inbox")
    events = table(spark, sf, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    hashed = F.substring(F.sha2(F.col("event_type"), 256), 1, 16)
    trades = events.select((F.col("user_id") % 4).alias("part"), "event_id", F.when(e % 7 != 0, day).alias("date"), F.col("event_type").alias("setup"))
    trades = trades.repartition(4, "part").sortWithinPartitions("part", "event_id")
    trades.write.partitionBy("part").option("header", True).csv(f"{root}/trades")
    sessions = F.struct("event_id", F.when(e % 5 != 0, day).alias("date"), F.col("event_type").alias("activity_type"))
    woke = F.date_format(F.col("ts") + F.expr("INTERVAL 8 HOURS"), "yyyy-MM-dd'T'HH:mm:ss")
    nights = F.struct(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("slept_at"), woke.alias("woke_at"),
        F.when(e % 9 != 0, F.lit(80)).otherwise(F.lit(0)).alias("quality_score"),
    )
    listed = lambda size, record: events.groupBy(F.floor(e / size)).agg(
        F.to_json(F.array_sort(F.collect_list(record))).alias("text")
    ).select("text")
    start = F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'")
    block = F.concat(F.lit("BEGIN:VEVENT\nDTSTART:"), start, F.lit("\nSUMMARY:work sync\nEND:VEVENT\n"))
    calendars = events.groupBy(F.floor(e / 800)).agg(F.array_sort(F.collect_list(F.struct("event_id", block.alias("b")))).alias("x"))
    notes = events.groupBy("event_type").agg(F.max(day).alias("day")).select(
        F.concat(F.lit("---\ndate: "), "day", F.lit("\ntags: A, b\n---\n# about "), "event_type").alias("text")
    )
    for name, documents in (
        ("sessions", listed(500, sessions)),
        ("nights", listed(600, nights)),
        ("calendars", calendars.select(F.array_join("x.b", "").alias("text"))),
        ("notes", notes),
    ):
        documents.write.option("maxRecordsPerFile", 1).option("lineSep", "\n\n").text(f"{root}/{name}")
    names = {"trades": "trade_log_{}.csv", "sessions": "training_{}.json", "nights": "sleep_{}.json", "calendars": "c{}.ics", "notes": "n{}.md"}
    for folder, name in names.items():
        _rename_parts(spark, f"{root}/{folder}", name)
    landing, rejects = work_dir(spark, "s19-landing"), work_dir(spark, "s19-rejects")
    inbox_plan.import_inbox(spark, root, landing, rejects, "2024-01-31 00:00:00", "2024-01-31", compression="gzip")
    payload = F.from_json("payload", "setup_hash string, activity_type string, row_number long, title_hash string")
    landed = files.read_landing(spark, f"{landing}/*/dt=*/*").withColumn("p", payload).withColumn(
        "place", F.element_at(F.split("idempotency_key", ":"), -1).cast("long")
    )
    label = F.coalesce("p.setup_hash", "p.activity_type", "p.title_hash", F.lit("-"))
    accepted = landed.groupBy("source_name").agg(
        rollups.rows("n"), F.count_distinct("event_id").alias("n_ids"), F.sum("place").alias("places"), F.count_distinct(label).alias("labels")
    )
    refused = spark.read.parquet(rejects).groupBy("source_name").agg(rollups.rows("rejected"), F.sum("row_number").alias("rejected_places"))
    zero = F.lit(0).cast("long")
    return accepted.join(refused, "source_name", "left").select(
        "source_name", "n", "n_ids", F.coalesce("rejected", zero).alias("rejected"), "places",
        F.coalesce("rejected_places", zero).alias("rejected_places"), "labels",
    )


def _rename_parts(spark, folder, pattern):
    """Written part files, at any depth, under names that say what they are."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # A folder at a time: listFiles asks for the blocks of every file, milliseconds each.
    folders, k = [path], 0
    while folders:
        for status in fs.listStatus(folders.pop()):
            file = status.getPath()
            name = file.getName()
            if status.isDirectory():
                folders.append(file)
            elif name.startswith("part-"):
                fs.rename(file, jvm.org.apache.hadoop.fs.Path(file.getParent(), pattern.format(k)))
                k += 1
            elif name == "_SUCCESS":
                fs.delete(file, False)
