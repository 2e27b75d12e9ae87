"""CSV/text readers and the Parquet sink on hand-written files."""

import datetime as dt
import os
import tempfile

from tessera.sources import readers, schemas, sinks

LINES = [
    "274878258468,2015-03-10 06:39:54,2015-03-10 06:46:00,-73.99421,40.7512,-73.98232,40.77542,8.3",
    "2,2015-03-10 07:00:00,2015-03-10 07:10:00,-73.9x,40.7,-73.8,40.8,5.0",
    "3,not a date,2015-03-10 07:10:00,-73.9,40.7,-73.8,40.8,5.0",
]


def _write(lines):
    d = tempfile.mkdtemp(prefix="tessera-test-")
    path = os.path.join(d, "trips.csv")
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_permissive_sets_bad_fields_null(spark):
    df = readers.read_csv(spark, _write(LINES), schemas.TRIPS, mode="PERMISSIVE")
    rows = {r.trip_id: r for r in df.collect()}
    assert rows["274878258468"].trip_start_time == dt.datetime(2015, 3, 10, 6, 39, 54)
    assert rows["274878258468"].trip_cost == 8.3
    assert rows["2"].trip_start_long is None and rows["2"].trip_start_lat == 40.7
    assert rows["3"].trip_start_time is None


def test_dropmalformed_drops_bad_records(spark):
    df = readers.read_csv(spark, _write(LINES), schemas.TRIPS, mode="DROPMALFORMED")
    assert [r.trip_id for r in df.collect()] == ["274878258468"]


def test_dropmalformed_sees_the_same_records_in_every_query(spark):
    bad = LINES + ["7,2015-03-10 07:00:00", LINES[0] + ",extra", "", LINES[0].replace("274878258468", "8")]
    df = readers.read_csv(spark, _write(bad), schemas.TRIPS, mode="DROPMALFORMED")
    ids = ["274878258468", "8"]
    assert [r.trip_id for r in df.collect()] == ids
    assert df.count() == 2
    assert [r.trip_id for r in df.select("trip_id").collect()] == ids
    assert df.where("trip_cost > 1").select("trip_end_lat").count() == 2


def test_dropmalformed_skips_the_header(spark):
    header = ",".join(schemas.TRIPS.names)
    df = readers.read_csv(spark, _write([header, *LINES]), schemas.TRIPS, mode="DROPMALFORMED", header=True)
    assert df.count() == 1


def test_complaint_ids_do_not_depend_on_splits(spark):
    path = _write(["2015-03-10,en,one two", "2015-03-10,en,three"])
    a = readers.read_complaints(spark, path).collect()
    b = readers.read_complaints(spark, path).repartition(3).collect()
    assert sorted(a) == sorted(b) and len({r.doc_id for r in a}) == 2


def test_parse_delimited_casts_and_counts_fields(spark):
    lines = readers.read_text(spark, _write(LINES + ["a,b"]))
    parsed = readers.parse_delimited(lines, schemas.TRIPS)
    assert parsed.count() == 4
    strict = readers.parse_delimited(lines, schemas.TRIPS, strict_fields=8).collect()
    assert [r.trip_id for r in strict] == ["274878258468", "2", "3"]
    assert strict[1].trip_start_long is None and strict[2].trip_start_time is None


def test_parquet_round_trip(spark):
    df = readers.read_csv(spark, _write(LINES[:1]), schemas.TRIPS)
    out = os.path.join(tempfile.mkdtemp(prefix="tessera-test-"), "p")
    sinks.write_parquet(df, out)
    back = readers.read_parquet(spark, out)
    assert back.schema == df.schema
    assert back.collect() == df.collect()


NOTES = schemas.T.StructType([
    schemas.T.StructField("id", schemas.T.LongType()), schemas.T.StructField("note", schemas.T.StringType()),
    schemas.T.StructField("cost", schemas.T.DoubleType()),
])


def _notes(spark, **files):
    d = tempfile.mkdtemp(prefix="tessera-test-")
    for name, text in files.items():
        with open(os.path.join(d, f"{name}.csv"), "w", newline="") as fh:
            fh.write(text)
    return readers.read_csv(spark, d, NOTES, mode="DROPMALFORMED", header=True, multi_line=True)


def test_records_that_span_lines_are_dropped_whole_or_not_at_all(spark):
    df = _notes(
        spark,
        a='id,note,cost\n1,"two\nlines, one record",1.5\nx,"bad\nid",2\n2,plain,3\n3,"broken cost\n",z\n4,short\n',
        b='id,note,cost\n5,"a \\"quote\n\nand blank",4\nid,note,cost\n6,"extra",1,2\n7,,\n',
    )
    want = {1: "two\nlines, one record", 2: "plain", 7: None}
    rows = df.collect()
    got = {r.id: r.note for r in rows}
    five = got.pop(5)
    assert got == want and len(rows) == 4 and "and blank" in five
    # Any projection, filter or count sees the same records.
    assert df.count() == 4 and sorted(r.id for r in df.select("id").collect()) == [1, 2, 5, 7]
    assert df.select("note").count() == 4 and df.where("cost > 1").select("note").count() == 3
    assert df.agg({"cost": "sum"}).first()[0] == 8.5


def test_only_the_first_line_of_a_file_is_its_header(spark):
    d = tempfile.mkdtemp(prefix="tessera-test-")
    for name in ("a", "b"):
        with open(os.path.join(d, f"{name}.csv"), "w") as fh:
            fh.write("trip_id,vendor_id\n1,A\ntrip_id,vendor_id\n2,B,3\n")
    df = readers.read_csv(spark, d, schemas.VENDORS, mode="DROPMALFORMED", header=True)
    assert sorted(map(tuple, df.collect())) == [("1", "A"), ("1", "A"), ("trip_id", "vendor_id"), ("trip_id", "vendor_id")]
    assert df.count() == 4 and df.select("vendor_id").count() == 4
    assert readers.read_csv(spark, d, schemas.VENDORS, mode="DROPMALFORMED").count() == 6


def _row_groups_read(path, low_long, high_long, low_lat, high_lat):
    """(row groups whose statistics meet the box, all row groups)."""
    import glob

    import pyarrow.parquet as pq

    met = every = 0
    for f in glob.glob(f"{path.removeprefix('file:')}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = meta.schema.to_arrow_schema().names
        for g in range(meta.num_row_groups):
            stats = [meta.row_group(g).column(names.index(c)).statistics for c in ("trip_start_long", "trip_start_lat")]
            every += 1
            met += all(s.max >= lo and s.min <= hi for s, lo, hi in zip(stats, (low_long, low_lat), (high_long, high_lat)))
    return met, every


def test_clustered_files_let_a_box_query_skip_row_groups(spark):
    from tessera.session import shared_path
    from tessera.sources import fixtures as fx
    from tessera.sources.sinks import csv_to_clustered, write_parquet

    csv = fx.trips_csv_path(spark, "/root/testdata/sf0.01")
    near = csv_to_clustered(spark, csv, shared_path(spark, "t-near"), rows_per_file=50)
    trips = readers.read_csv(spark, csv, schemas.TRIPS, mode="DROPMALFORMED")
    far = write_parquet(trips.repartition(50), shared_path(spark, "t-far"))
    assert sorted(map(tuple, spark.read.parquet(near).collect())) == sorted(map(tuple, trips.collect()))
    box = (-74.5, -73.0, 40.0, 41.5)
    met, every = _row_groups_read(near, *box)
    met_far, every_far = _row_groups_read(far, *box)
    assert met_far == every_far and every >= 40 and met <= every / 4, (met, every)
    # Without the rows outside the bounding box, of which there are many.
    met, _ = _row_groups_read(near, -80.0, -71.0, 40.0, 45.0)
    assert met < 0.75 * every, (met, every)


def test_z_order_of_borders_nulls_and_neighbours(spark):
    from tessera.functions.geo import z_order

    rows = [(0.0, 0.0), (1.0, 1.0), (-5.0, 9.0), (None, 0.5), (0.5, None), (0.99, 0.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = [r.z for r in df.select(z_order("x", "y", (0.0, 1.0), (0.0, 1.0), 2).alias("z")).collect()]
    assert got == [0, 15, 10, None, None, 5]
