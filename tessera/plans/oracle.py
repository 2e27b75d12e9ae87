"""Reference SQL (DuckDB dialect) for every query that SQL can express.

The CTEs restate ``tessera.sources.fixtures`` over the raw tables; the
bodies restate the Spark plans. Column names and types match the Spark
output (``hour`` is cast to INTEGER, counts are BIGINT, and so on).
"""

from __future__ import annotations

from tessera.functions.predicates import LAT_MAX, LAT_MIN, LONG_MAX, LONG_MIN
from tessera.functions.text import STOP_WORDS
from tessera.sources import fixtures as fx

TRIPS = f"""trips AS (
  SELECT CAST(event_id AS VARCHAR) AS trip_id,
         ts AS trip_start_time,
         ts + to_seconds((event_id * 7919) % 3720 - 120) AS trip_end_time,
         -82 + ((event_id * 37) % 1536) / CAST(128 AS DOUBLE) AS trip_start_long,
         39 + ((event_id * 53) % 896) / CAST(128 AS DOUBLE) AS trip_start_lat,
         -82 + ((event_id * 101 + user_id) % 1536) / CAST(128 AS DOUBLE) AS trip_end_long,
         39 + ((event_id * 29 + user_id) % 896) / CAST(128 AS DOUBLE) AS trip_end_lat,
         value AS trip_cost,
         event_id
  FROM events)"""

VENDORS = f"""vendors AS (
  SELECT CAST(event_id AS VARCHAR) AS trip_id,
         CAST(1 + user_id % 2 AS VARCHAR) AS vendor_id
  FROM events WHERE event_id % {fx.NO_VENDOR_MOD} <> 0)"""

# Trips as they come back from the CSV rendering: times cut to the second,
# and the malformed fields NULL (PERMISSIVE).
TRIPS_CSV = f"""trips_csv AS (
  SELECT trip_id,
         CASE WHEN event_id % {fx.BAD_TIME_MOD} = {fx.BAD_TIME_REM} THEN NULL
              ELSE date_trunc('second', trip_start_time) END AS trip_start_time,
         date_trunc('second', trip_end_time) AS trip_end_time,
         trip_start_long,
         CASE WHEN event_id % {fx.BAD_LAT_MOD} = {fx.BAD_LAT_REM} THEN NULL
              ELSE trip_start_lat END AS trip_start_lat,
         trip_end_long, trip_end_lat, trip_cost,
         (event_id % {fx.BAD_TIME_MOD} = {fx.BAD_TIME_REM}
          OR event_id % {fx.BAD_LAT_MOD} = {fx.BAD_LAT_REM}) AS malformed
  FROM trips)"""

TRIP_LINES = f"""trip_lines AS (
  SELECT concat_ws(',', trip_id,
           CASE WHEN event_id % {fx.BAD_TIME_MOD} = {fx.BAD_TIME_REM} THEN 'n/a'
                ELSE strftime(trip_start_time, '%Y-%m-%d %H:%M:%S') END,
           strftime(trip_end_time, '%Y-%m-%d %H:%M:%S'),
           CAST(trip_start_long AS VARCHAR),
           CASE WHEN event_id % {fx.BAD_LAT_MOD} = {fx.BAD_LAT_REM} THEN 'NA'
                ELSE CAST(trip_start_lat AS VARCHAR) END,
           CAST(trip_end_long AS VARCHAR), CAST(trip_end_lat AS VARCHAR),
           CAST(trip_cost AS VARCHAR)) AS value
  FROM trips)"""

COLS8 = (
    "trip_id, trip_start_time, trip_end_time, trip_start_long, trip_start_lat, "
    "trip_end_long, trip_end_lat, trip_cost"
)


def _box(p: str = "") -> str:
    parts = []
    for lng, lat in (("trip_start_long", "trip_start_lat"), ("trip_end_long", "trip_end_lat")):
        parts.append(
            f"{p}{lat} >= {LAT_MIN} AND {p}{lat} <= {LAT_MAX} AND "
            f"{p}{lng} >= {LONG_MIN} AND {p}{lng} <= {LONG_MAX}"
        )
    return " AND ".join(parts)


def _clean(p: str = "") -> str:
    return (
        f"{_box(p)} AND {p}trip_start_time < {p}trip_end_time "
        f"AND {p}trip_start_long <> {p}trip_end_long AND {p}trip_start_lat <> {p}trip_end_lat"
    )


BOX, CLEAN = _box(), _clean()
_DEG = "CAST('0.017453292519943295' AS DOUBLE)"  # pi/180 as Java's toRadians uses it


def _haversine(radians: bool) -> str:
    lon1, lat1, lon2, lat2 = POINTS = (
        "trip_start_long", "trip_start_lat", "trip_end_long", "trip_end_lat")
    if radians:
        lon1, lat1, lon2, lat2 = (f"({c} * {_DEG})" for c in POINTS)
    a = (
        f"least(1.0, greatest(0.0, pow(sin(({lat2} - {lat1}) / 2), 2) + "
        f"cos({lat1}) * cos({lat2}) * pow(sin(({lon2} - {lon1}) / 2), 2)))"
    )
    return f"(CAST(12742.0 AS DOUBLE) * atan2(sqrt({a}), sqrt(1.0 - {a})))"


DIST_KM = f"round({_haversine(True)}, 6)"
DIST_COMPAT = f"round({_haversine(False)}, 6)"
DURATION = (
    "(CAST(date_diff('microsecond', trip_start_time, trip_end_time) AS DOUBLE) "
    "/ CAST(60000000 AS DOUBLE))"
)


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _joined(where: str) -> str:
    return f"""joined AS (
  SELECT v.vendor_id, t.trip_id, {DIST_COMPAT} AS distance, {DURATION} AS duration
  FROM trips t JOIN vendors v ON t.trip_id = v.trip_id
  WHERE {where})"""


def _hourly(src: str, where: str) -> str:
    return f"""
SELECT CAST(hour(trip_start_time) AS INTEGER) AS start_hour,
       avg(trip_start_long) AS avg_start_long,
       avg(trip_start_lat) AS avg_start_lat
FROM {src} WHERE {where}
GROUP BY 1 ORDER BY 1"""


TAXI = {
    "hourly_avg_pickup": with_ctes(TRIPS, body=_hourly("trips", CLEAN)),
    "hourly_avg_pickup_csv": with_ctes(TRIPS, TRIPS_CSV, body=_hourly("trips_csv", CLEAN)),
    "hourly_avg_pickup_text": with_ctes(TRIPS, TRIPS_CSV, body=_hourly("trips_csv", CLEAN)),
    "hourly_avg_pickup_stream": with_ctes(TRIPS, body=_hourly("trips", CLEAN)),
    "fn_hour": with_ctes(
        TRIPS, body="SELECT trip_id, CAST(hour(trip_start_time) AS INTEGER) AS start_hour FROM trips"),
    "fn_hour_label": with_ctes(
        TRIPS, body="SELECT trip_id, strftime(trip_start_time, '%H') AS hour_label FROM trips"),
    "trip_duration": with_ctes(TRIPS, body=f"SELECT trip_id, {DURATION} AS duration FROM trips"),
    "haversine_km": with_ctes(TRIPS, body=f"SELECT trip_id, {DIST_KM} AS distance FROM trips"),
    "haversine_compat": with_ctes(TRIPS, body=f"SELECT trip_id, {DIST_COMPAT} AS distance FROM trips"),
    "udf_haversine": with_ctes(TRIPS, body=f"SELECT trip_id, {DIST_KM} AS distance FROM trips"),
    "filter_bbox": with_ctes(TRIPS, body=f"SELECT {COLS8} FROM trips WHERE {BOX}"),
    "filter_clean_trips": with_ctes(TRIPS, body=f"SELECT {COLS8} FROM trips WHERE {CLEAN}"),
    "project_columns": with_ctes(
        TRIPS, body="SELECT trip_id, trip_start_long, trip_start_lat FROM trips"),
    "sort_asc": with_ctes(
        TRIPS, body="SELECT trip_id, trip_start_time, trip_cost FROM trips ORDER BY trip_start_time, trip_id"),
    "scan_parquet": with_ctes(TRIPS, body=f"SELECT {COLS8} FROM trips"),
    "longest_trip_argmax": with_ctes(TRIPS, VENDORS, _joined(CLEAN), body="""
SELECT vendor_id, trip_id, distance, duration FROM (
  SELECT *, row_number() OVER (PARTITION BY vendor_id
            ORDER BY distance DESC, duration DESC, trip_id DESC) AS rn
  FROM joined) WHERE rn = 1 ORDER BY vendor_id"""),
    "longest_trip_window": with_ctes(TRIPS, VENDORS, _joined(BOX), body="""
SELECT vendor_id, trip_id, distance, duration FROM (
  SELECT *, max(distance) OVER (PARTITION BY vendor_id) AS max_distance FROM joined)
WHERE distance = max_distance"""),
    "window_max": with_ctes(TRIPS, VENDORS, _joined(BOX), body="""
SELECT vendor_id, trip_id, distance, duration,
       max(distance) OVER (PARTITION BY vendor_id) AS max_distance
FROM joined"""),
    "join_inner": with_ctes(TRIPS, VENDORS, body=f"""
SELECT t.trip_id, trip_start_time, trip_end_time, trip_start_long, trip_start_lat,
       trip_end_long, trip_end_lat, trip_cost, v.vendor_id
FROM trips t JOIN vendors v ON t.trip_id = v.trip_id"""),
    "limit_build_side": with_ctes(
        VENDORS, body="SELECT trip_id, vendor_id FROM vendors ORDER BY trip_id LIMIT 50"),
}
TAXI["longest_trip_sql"] = TAXI["longest_trip_window"]
TAXI["longest_trip_stream"] = TAXI["longest_trip_argmax"]
_BOUNDED_JOIN = with_ctes(TRIPS, VENDORS, body=f"""
SELECT t.trip_id, trip_start_time, trip_end_time, trip_start_long, trip_start_lat,
       trip_end_long, trip_end_lat, trip_cost, v.vendor_id
FROM trips t JOIN (SELECT * FROM vendors ORDER BY trip_id LIMIT 50) v ON t.trip_id = v.trip_id""")
TAXI["join_broadcast"] = _BOUNDED_JOIN
TAXI["join_sort_merge"] = _BOUNDED_JOIN


VENDORS_CSV = VENDORS.replace("vendors AS", "vendors_csv AS")

INGEST = {
    "scan_text": with_ctes(TRIPS, TRIP_LINES, body="SELECT value FROM trip_lines"),
    "parse_delimited": with_ctes(TRIPS, TRIPS_CSV, body=f"SELECT {COLS8} FROM trips_csv"),
    "scan_csv": with_ctes(TRIPS, TRIPS_CSV, body=f"SELECT {COLS8} FROM trips_csv"),
    "scan_csv_dropmalformed": with_ctes(
        TRIPS, TRIPS_CSV, body=f"SELECT {COLS8} FROM trips_csv WHERE NOT malformed"),
    "count_dropmalformed": with_ctes(TRIPS, TRIPS_CSV, body="""
SELECT count(*) AS n, min(trip_id) AS first_id, max(trip_id) AS last_id FROM trips_csv WHERE NOT malformed"""),
    "csv_to_parquet_vendors": with_ctes(VENDORS, body="SELECT trip_id, vendor_id FROM vendors"),
    "csv_to_parquet": with_ctes(
        TRIPS, TRIPS_CSV, body=f"SELECT {COLS8} FROM trips_csv WHERE NOT malformed"),
    "longest_trip_csv": with_ctes(TRIPS, TRIPS_CSV, VENDORS, f"""joined AS (
  SELECT v.vendor_id, t.trip_id, {DIST_COMPAT} AS distance, {DURATION} AS duration
  FROM trips_csv t JOIN vendors v ON t.trip_id = v.trip_id
  WHERE {BOX})""", body="""
SELECT vendor_id, trip_id, distance, duration FROM (
  SELECT *, max(distance) OVER (PARTITION BY vendor_id) AS max_distance FROM joined)
WHERE distance = max_distance"""),
}


INGEST["longest_trip_bucketed"] = with_ctes(TRIPS, TRIPS_CSV, VENDORS, f"""joined AS (
  SELECT v.vendor_id, t.trip_id, {DIST_COMPAT} AS distance, {DURATION} AS duration
  FROM trips_csv t JOIN vendors v ON t.trip_id = v.trip_id
  WHERE {BOX} AND NOT t.malformed)""", body="""
SELECT vendor_id, trip_id, distance, duration FROM (
  SELECT *, max(distance) OVER (PARTITION BY vendor_id) AS max_distance FROM joined)
WHERE distance = max_distance""")


INGEST["filter_bbox_clustered"] = with_ctes(
    TRIPS, TRIPS_CSV, body=f"SELECT {COLS8} FROM trips_csv WHERE NOT malformed AND {BOX}")
INGEST["scan_csv_multiline"] = f"""
SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text FROM documents
WHERE doc_id IS NULL OR doc_id % {fx.BAD_TIME_MOD} <> {fx.BAD_TIME_REM}"""


INGEST["longest_trip_argmax_text"] = with_ctes(TRIPS, TRIPS_CSV, VENDORS, f"""joined AS (
  SELECT v.vendor_id, t.trip_id, {DIST_COMPAT} AS distance, {DURATION} AS duration
  FROM trips_csv t JOIN vendors v ON t.trip_id = v.trip_id
  WHERE {CLEAN})""", body="""
SELECT vendor_id, trip_id, distance, duration FROM (
  SELECT *, row_number() OVER (PARTITION BY vendor_id
            ORDER BY distance DESC, duration DESC, trip_id DESC) AS rn
  FROM joined) WHERE rn = 1 ORDER BY vendor_id""")


def stop_words_sql() -> str:
    """The stop-word list as a parenthesised SQL IN list."""
    quoted = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)
    return f"({quoted})"


COMPLAINTS = f"""complaints AS (
  SELECT doc_id,
         concat(CASE WHEN doc_id % {fx.SKIPPED_YEAR_MOD} = 0 THEN '2009' ELSE '2015' END,
                '-03-10,', lang, ',',
                CASE WHEN doc_id % {fx.KEEP_COMMAS_MOD} = 0 THEN text
                     ELSE replace(text, ',', ' ') END) AS line
  FROM documents)"""
VALID = """valid AS (
  SELECT doc_id, parts[2] AS label, parts[3] AS comment FROM (
    SELECT doc_id, string_split(line, ',') AS parts FROM complaints)
  WHERE len(parts) = 3 AND length(parts[3]) > 0 AND starts_with(parts[1], '201'))"""
CLEANED = """cleaned AS (
  SELECT doc_id, label, trim(lower(regexp_replace(comment, '[^a-zA-Z]+', ' ', 'g'))) AS clean
  FROM valid)"""
TOKENS = """tokens AS (
  SELECT doc_id, label, CAST(unnest(range(len(w))) AS INTEGER) AS pos, unnest(w) AS word
  FROM (SELECT doc_id, label, string_split(clean, ' ') AS w FROM cleaned))"""
CONTENT = f"""content AS (
  SELECT doc_id, pos, word FROM tokens WHERE word NOT IN {stop_words_sql()})"""
WORD_COUNT = """word_count AS (SELECT word, count(*) AS n FROM content GROUP BY word)"""
LEXICON = """lexicon AS (
  SELECT CAST(row_number() OVER (ORDER BY n DESC, word) - 1 AS INTEGER) AS idx, word, n
  FROM word_count ORDER BY n DESC, word LIMIT 50)"""
LEX_TOKENS = """lex_tokens AS (
  SELECT t.doc_id, t.label, t.pos, t.word, l.idx FROM tokens t JOIN lexicon l ON t.word = l.word)"""
TF = """tf AS (
  SELECT doc_id, label, word, idx, count(*) AS tf FROM lex_tokens GROUP BY doc_id, label, word, idx)"""
DF = """dfreq AS (SELECT word, count(*) AS df FROM tf GROUP BY word)"""
IDF = """idf AS (
  SELECT word, ln((SELECT count(*) FROM valid) / CAST(df AS DOUBLE)) AS idf FROM dfreq)"""
TF_NORM = """tf_norm AS (
  SELECT doc_id, label, word, idx,
         CAST(0.5 AS DOUBLE) + CAST(0.5 AS DOUBLE) * tf / max(tf) OVER (PARTITION BY doc_id) AS tf_norm
  FROM tf)"""
TFIDF = """tfidf AS (
  SELECT n.doc_id, n.label, n.idx, n.word, n.tf_norm * i.idf AS weight
  FROM tf_norm n JOIN idf i ON n.word = i.word)"""
VECTORS = """vectors AS (
  SELECT doc_id, label AS label_f,
         string_agg(CAST(idx AS VARCHAR) || ':' || CAST(CAST(round(weight * 1000000) AS BIGINT) AS VARCHAR),
                    ' ' ORDER BY idx) AS features_key
  FROM tfidf GROUP BY doc_id, label)"""

TEXT_CHAIN = [COMPLAINTS, VALID, CLEANED, TOKENS, CONTENT, WORD_COUNT, LEXICON, LEX_TOKENS,
              TF, DF, IDF, TF_NORM, TFIDF, VECTORS]


def text_sql(upto: str, body: str) -> str:
    """CTE chain of the text pipeline up to the CTE named ``upto``."""
    names = [c.split(" AS ", 1)[0] for c in TEXT_CHAIN]
    return with_ctes(*TEXT_CHAIN[: names.index(upto) + 1], body=body)


TEXT = {
    "filter_valid_records": text_sql("valid", "SELECT doc_id, label, comment FROM valid"),
    "clean_text": text_sql("cleaned", "SELECT doc_id, label, clean FROM cleaned"),
    "tokenize_explode": text_sql("tokens", "SELECT doc_id, label, pos, word FROM tokens"),
    "remove_stopwords": text_sql("content", "SELECT doc_id, pos, word FROM content"),
    "word_count": text_sql("word_count", "SELECT word, n FROM word_count"),
    "top_k_words": text_sql("word_count", "SELECT word, n FROM word_count ORDER BY n DESC, word LIMIT 50"),
    "lexicon": text_sql("lexicon", "SELECT idx, word, n FROM lexicon"),
    "filter_to_lexicon": text_sql("lex_tokens", "SELECT doc_id, label, pos, word, idx FROM lex_tokens"),
    "term_frequency": text_sql("tf", "SELECT doc_id, label, word, idx, tf FROM tf"),
    "document_frequency": text_sql("dfreq", "SELECT word, df FROM dfreq"),
    "idf": text_sql("idf", "SELECT word, round(idf, 6) AS idf FROM idf"),
    "tf_double_norm": text_sql("tf_norm", "SELECT doc_id, label, word, idx, tf_norm FROM tf_norm"),
    "tfidf": text_sql("tfidf", "SELECT doc_id, label, idx, word, round(weight, 6) AS weight FROM tfidf"),
    "tfidf_sparse": text_sql(
        "tfidf",
        "SELECT doc_id, label AS label_f, idx, round(weight, 6) AS value FROM tfidf WHERE weight <> 0"),
}


# The same chain over records read from text lines: line breaks are spaces and
# the id is the MD5 of the line.
_FILE_CHAIN = [
    COMPLAINTS.replace("complaints AS", "raw_complaints AS"),
    "complaints AS (SELECT md5(l) AS doc_id, l AS line FROM "
    "(SELECT translate(line, chr(10) || chr(13), '  ') AS l FROM raw_complaints))",
    *TEXT_CHAIN[1:],
]
TEXT["valid_records_file"] = with_ctes(*_FILE_CHAIN[:3], body="SELECT doc_id, label, comment FROM valid")
TEXT["word_count_file"] = with_ctes(*_FILE_CHAIN[:7], body="SELECT word, n FROM word_count")


LABELLED = """labelled AS (
  SELECT v.doc_id, v.label_f, li.label, v.features_key
  FROM vectors v JOIN (
    SELECT label_f, CAST(row_number() OVER (ORDER BY n DESC, label_f) - 1 AS DOUBLE) AS label
    FROM (SELECT label_f, count(*) AS n FROM vectors GROUP BY label_f)) li
  ON v.label_f = li.label_f)"""
ROWS = """rows AS (SELECT DISTINCT label_f, label, features_key FROM labelled)"""
SPLIT = """split AS (
  SELECT label_f, label, features_key,
         CASE WHEN CAST('0x' || substr(md5(concat_ws('|', '10', label_f, features_key)), 1, 8) AS BIGINT)
                   % 10000 < 8000 THEN 'train' ELSE 'test' END AS split
  FROM rows)"""


def learn_sql(body: str) -> str:
    return with_ctes(*TEXT_CHAIN, LABELLED, ROWS, SPLIT, body=body)


LEARN = {
    "label_index": learn_sql("SELECT label_f, label, count(*) AS n FROM labelled GROUP BY label_f, label"),
    "dedup_rows": learn_sql("SELECT label_f, label, features_key FROM rows"),
    "class_counts": learn_sql("""
SELECT 'all' AS split, label_f, count(*) AS n FROM split GROUP BY label_f
UNION ALL
SELECT split, label_f, count(*) AS n FROM split GROUP BY split, label_f"""),
    "class_cardinality": learn_sql("SELECT count(DISTINCT label_f) AS n_classes FROM rows"),
    "distinct_labels": learn_sql("SELECT DISTINCT label_f, label FROM rows"),
    "stratified_split_hash": learn_sql("SELECT label_f, label, features_key, split FROM split"),
    "stratified_split_exact": learn_sql("""
SELECT label_f, label, features_key,
       CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', '10', label_f, features_key)))
                 <= floor(0.8 * count(*) OVER (PARTITION BY label) + 0.5) THEN 'train' ELSE 'test' END AS split
FROM rows"""),
    "except_distinct": learn_sql("""
SELECT label_f, label, features_key FROM rows
EXCEPT
SELECT label_f, label, features_key FROM split WHERE split = 'train'"""),
    "except_all": learn_sql("""
SELECT label_f, label, features_key FROM labelled
EXCEPT ALL
SELECT label_f, label, features_key FROM split WHERE split = 'train'"""),
    "number_rows": text_sql("valid", "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM valid"),
}

# Lines stand in the file in the order of the documents table, that of doc_id.
LEARN["number_lines"] = with_ctes(
    COMPLAINTS,
    "lines AS (SELECT doc_id AS place, translate(line, chr(10) || chr(13), '  ') AS line FROM complaints)",
    body="""
SELECT md5(line) AS doc_id, row_number() OVER (ORDER BY place) - 1 AS row_idx FROM (
  SELECT place, line, string_split(line, ',') AS parts FROM lines)
WHERE len(parts) = 3 AND length(parts[3]) > 0 AND starts_with(parts[1], '201')""")

TAXI["join_hot_keys"] = TAXI["join_inner"]

ORACLE: dict[str, str] = {}
ORACLE.update(TAXI)
ORACLE.update(INGEST)
ORACLE.update(TEXT)
ORACLE.update(LEARN)
