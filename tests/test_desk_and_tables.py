import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.operators import quality
from ridelake.plans import desk
from ridelake.session import path_exists, staging_path
from ridelake.sources import scans, tables
from ridelake.sources.datasets import TICKETS, USERS

TICKET = {
    "id": 5, "assignee_id": 0, "group_id": None, "requester_id": 7, "brand_id": 1, "submitter_id": 2,
    "created_at": "2024-01-01T23:59:59Z", "updated_at": "2024-01-02T00:00:00Z", "generated_timestamp": 1704067200,
    "status": "open", "description": "", "type": None, "priority": "high", "ticket_form_id": 0, "tags": ["a", "b"],
    "custom_fields": [
        {"id": 1, "value": True}, {"id": 2, "value": "true"}, {"id": 3, "value": ["x", "y"]}, {"id": 4, "value": None},
        {"id": 5, "value": 12}, {"id": 6, "value": []}, {"id": 7, "value": False},
    ],
    "via": {"channel": "web", "source": {"to": {}, "from": {"name": "김", "address": "k@e.com"}, "rel": "follow_up"}},
}


def land(path, name, document):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(json.dumps(document, ensure_ascii=False, indent=1), encoding="utf-8")


def test_ticket_page(spark, tmp_path):
    land(tmp_path / "t", "tickets-0003.json", {"tickets": [TICKET], "next_page": None, "end_of_stream": True})
    (tmp_path / "t" / "tickets-0004.json").write_text("{broken")
    pages = scans.read_pages(spark, str(tmp_path / "t"), TICKETS.page_schema)
    [row] = TICKETS.normalise(pages).collect()
    assert (row.id, row.assignee_id, row.group_id, row.requester_id, row.ticket_form_id) == (5, None, None, 7, None)
    assert row.created_at == dt.datetime(2024, 1, 1, 23, 59, 59) and row.generated_timestamp == dt.datetime(2024, 1, 1)
    assert (row.description, row.type, row.priority, row.tags) == (None, None, "high", ["a", "b"])
    assert [(f.id, f.value) for f in row.custom_fields] == [
        (1, "True"), (2, "true"), (3, "x\ny\n"), (4, None), (5, "12"), (6, ""), (7, "False")
    ]
    assert (row.channel, row.source_to, row.source_rel) == ("web", None, '"follow_up"')
    assert json.loads(row.source_from) == {"name": "김", "address": "k@e.com"} and "김" in row.source_from
    assert (row.page, row.pos) == (3, 0)

    assert pages.count() == 1
    bad = scans.quarantined_json(spark, str(tmp_path / "t"), TICKETS.page_schema, multi_line=True)
    assert [tuple(r) for r in bad.select("file_name", "block_start", "reason", "text").collect()] == [("tickets-0004.json", 0, scans.NOT_JSON, "{broken")]
    with pytest.raises(Exception, match="rejected"):
        scans.read_pages(spark, str(tmp_path / "t"), TICKETS.page_schema, strict=True).collect()


def test_line_delimited_load(spark, tmp_path, rows):
    lines = ['{"id": 1, "v": "a"}', "{oops", '{"id": 2}', '{"other": 3}', '{"id": "no number"}']
    (tmp_path / "x.json").write_text("\n".join(lines) + "\n", encoding="utf-8")
    accepted = scans.read_landed_json(spark, str(tmp_path), "id BIGINT, v STRING")
    assert rows(accepted) == sorted([(1, "a"), (2, None)], key=repr)
    refused = scans.quarantined_json(spark, str(tmp_path), "id BIGINT, v STRING")
    assert rows(refused, "reason", "text") == sorted(
        [(scans.NOT_JSON, "{oops"), (scans.NO_FIELD, '{"other": 3}'), (scans.WRONG_TYPE + "id", '{"id": "no number"}')], key=repr
    )
    assert accepted.count() + refused.count() == len(lines)


def test_search_pages_have_no_generated_timestamp(spark, tmp_path):
    land(tmp_path / "s", "p1.json", {"results": [TICKET], "next_page": None})
    pages = scans.read_pages(spark, str(tmp_path / "s"), schemas.TICKET_PAGE)
    [row] = desk.ticket_normalize(pages, "search").collect()
    assert row.id == 5 and row.generated_timestamp is None


def test_normalised_rows_have_the_declared_schema(spark, tmp_path):
    land(tmp_path / "t", "t-1.json", {"tickets": [TICKET]})
    got = desk.dedupe_last_by_id(desk.ticket_normalize(scans.read_pages(spark, str(tmp_path / "t"), schemas.TICKET_PAGE)))
    declared = spark.createDataFrame([], schemas.TICKET)
    assert got.columns == declared.columns
    assert [f.dataType.simpleString() for f in got.schema] == [f.dataType.simpleString() for f in declared.schema]


def test_metric_durations_become_lists(spark):
    metric = {"id": 1, "ticket_id": 2, "reopens": 0, "replies": 1, "group_stations": 1, "assignee_stations": 1,
              "solved_at": None, "assigned_at": "2024-01-01T00:00:01Z", "created_at": "2024-01-01T00:00:00Z",
              "updated_at": "2024-01-01T00:00:00Z", "reply_time_in_minutes": {"calendar": 3, "business": None}}
    pages = spark.createDataFrame([(json.dumps({"page": 1, "ticket_metrics": [metric]}),)], "t STRING").select(
        F.from_json("t", schemas.METRIC_PAGE).alias("p")
    ).select("p.*")
    [row] = desk.ticket_metric_normalize(pages).collect()
    assert (row.reopens, row.solved_at, row.on_hold_time_in_minutes) == (0, None, None)
    assert [tuple(x) for x in row.reply_time_in_minutes] == [(3, None)]


def test_last_occurrence_wins_across_pages(spark, rows):
    records = spark.createDataFrame([(1, "a", 1, 0), (1, "b", 1, 5), (1, "c", 2, 0), (2, "d", 1, 1)], "id INT, v STRING, page INT, pos INT")
    assert rows(desk.dedupe_last_by_id(records)) == [(1, "c"), (2, "d")]


def test_nothing_that_landed_is_lost(spark, tmp_path):
    """Accepted and quarantined texts are the landed documents byte for byte, with the reason and in file order."""
    good = [b'{"id":1,"kind":"a"}', b'[{"id":5},{"kind":"z"}]', b'  {"id":2}\t', b'{"id":null,"kind":"q"}', b'{"kind":{"a":1}}', b'{"id":11,"kind":"\xff\xfe"}', b'{"id":8,"sub":{"n":3}}']
    bad = {
        b'{"id":1} trailing': "unparsable", b'{"id":1} {"id":2}': "unparsable", b'{"id":1},{"id":2}': "unparsable", b"nonsense": "unparsable", b"[": "unparsable",
        b'[{"id":5},{"id":"x"}]': "wrong type: id", b'{"id":99999999999999999999999}': "wrong type: id", b'{"id":1.5}': "wrong type: id",
        b'{"id":7,"sub":{"n":"bad"}}': "wrong type: inside a field", b"17": "wrong type: inside a field",
        b'{"other":3}': "no declared field", b'{"id":null,"kind":null}': "no declared field", b"{}": "no declared field",
    }
    landed = [line for pair in zip(good + good, bad, strict=False) for line in pair]
    (tmp_path / "a.json").write_bytes(b"\n".join([*landed, b"", b"  "]))
    (tmp_path / "empty.json").write_bytes(b"")
    schema = "id BIGINT, kind STRING, sub STRUCT<n: INT>"
    accepted = scans.accepted_texts(spark, str(tmp_path), schema).select(F.col("text").cast("binary")).collect()
    refused = scans.quarantined_json(spark, str(tmp_path), schema).orderBy("document_order").select(F.col("text").cast("binary"), "reason", "file_name", "block_start").collect()
    assert sorted([bytes(r[0]) for r in accepted] + [bytes(r[0]) for r in refused]) == sorted(landed)
    assert [(bytes(r[0]), r[1]) for r in refused] == list(bad.items())
    assert {r[2:] for r in refused} == {("a.json", 0)}
    got = scans.read_landed_json(spark, str(tmp_path), schema)
    assert got.columns == ["id", "kind", "sub"] and got.count() == sum(2 if x.startswith(b"[") else 1 for x in landed if x not in bad)


def test_pages_stop_at_the_first_empty_one(spark, rows):
    pages = spark.createDataFrame([(1, [1]), (2, [2]), (3, []), (4, [4])], "page BIGINT, users ARRAY<INT>")
    assert rows(desk.usable_pages(pages, "users"), "page") == [(1,), (2,)]
    assert rows(desk.usable_pages(pages.where("page <> 3"), "users"), "page") == [(1,), (2,), (4,)]
    assert desk.usable_pages(pages.where("page >= 3"), "users").isEmpty()
    unnumbered = pages.unionByName(spark.createDataFrame([(None, [9])], pages.schema))
    assert rows(desk.usable_pages(unnumbered, "users"), "users") == [([1],), ([2],), ([9],)]


def stored_rows(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("id", "v", F.date_format("created_at", "yyyy-MM-dd"), "day").collect())


def batch(spark, items):
    return spark.createDataFrame(
        [(i, v, dt.datetime.fromisoformat(c) if c else None) for i, v, c in items], "id INT, v STRING, created_at TIMESTAMP"
    )


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "table")
    first = batch(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (3, "c", "2024-01-02"), (4, "d", "2024-01-03")])
    assert tables.load_start(spark, path, 99) == tables.FIRST_LOAD_START
    assert tables.upsert_table(first.limit(0), path, "created_at") == "empty"
    assert not path_exists(spark, path)
    assert tables.upsert_table(first, path, "created_at") == "created"
    assert tables.load_start(spark, path, 99) == 99

    untouched = sorted(p.name for p in (tmp_path / "table" / "day=2024-01-01").iterdir())
    # 3 moves to another day and leaves its partition empty, 4 gets a NULL, 5 is new.
    second = batch(spark, [(3, "c2", "2024-01-04"), (4, None, "2024-01-03"), (5, "e", "2024-01-04")])
    for _ in range(2):  # repeating an upsert changes nothing
        assert tables.upsert_table(second, path, "created_at") == "merged"
        assert [r[:3] for r in stored_rows(spark, path)] == [
            (1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (3, "c2", "2024-01-04"), (4, None, "2024-01-03"), (5, "e", "2024-01-04")
        ]
    assert not (tmp_path / "table" / "day=2024-01-02").exists()
    assert sorted(p.name for p in (tmp_path / "table" / "day=2024-01-01").iterdir()) == untouched


def test_upsert_can_keep_stored_values(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.upsert_table(batch(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-01")]), path, "created_at")
    tables.upsert_table(batch(spark, [(1, None, "2024-01-02"), (2, "z", None)]), path, "created_at", coalesce_null=True)
    assert [r[:3] for r in stored_rows(spark, path)] == [(1, "a", "2024-01-02"), (2, "z", "2024-01-01")]


def test_merged_equals_a_merge(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, v STRING")
    source = spark.createDataFrame([(2, None), (3, "c")], "id INT, v STRING")
    assert rows(tables.merged(target, source)) == sorted([(1, "a"), (2, None), (3, "c")], key=repr)


def test_staged_copy_is_removed_on_failure(spark):
    with pytest.raises(RuntimeError):
        with tables.staged(spark.range(3), "x") as copy:
            path = copy.inputFiles()[0].rsplit("/", 1)[0]
            assert path_exists(spark, path)
            raise RuntimeError
    assert not path_exists(spark, path)


DAYS = "id INT, date_kr DATE"


def test_partition_refresh(spark, tmp_path, rows):
    path, day1, day2 = str(tmp_path / "p"), dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    source = spark.createDataFrame([(1, day1), (2, day1), (3, day2)], DAYS)
    tables.overwrite_table(source, path, "date_kr")
    other = sorted(p.name for p in (tmp_path / "p" / "date_kr=2024-01-02").iterdir())
    assert tables.refresh_day(source, path, day1) == "skipped"

    tables.overwrite_day(spark.createDataFrame([(9, day1), (8, day2)], DAYS), path, day1)
    assert rows(spark.read.parquet(path), "id", "date_kr") == [(3, day2), (9, day1)]
    assert sorted(p.name for p in (tmp_path / "p" / "date_kr=2024-01-02").iterdir()) == other

    tables.overwrite_day(source.limit(0), path, day1)
    assert rows(spark.read.parquet(path), "id") == [(3,)]
    failing = quality.value_check(source, F.count_distinct("id"), 99, "ids")
    with pytest.raises(ValueError, match="ids"):
        tables.refresh_day(source, path, day1, checks=failing)
    passing = quality.value_check(source.where(F.col("date_kr") == F.lit(day1)), F.count_distinct("id"), 2, "ids")
    assert tables.refresh_day(source, path, day1, checks=passing) == "loaded"
    assert rows(spark.read.parquet(path), "id") == [(1,), (2,), (3,)]

    tables.overwrite_table(source.where(F.col("date_kr") == F.lit(day2)), path, "date_kr")
    assert rows(spark.read.parquet(path), "id") == [(3,)]


def test_table_may_be_rewritten_from_itself(spark, tmp_path, rows):
    path = str(tmp_path / "p")
    tables.overwrite_table(spark.createDataFrame([(1, dt.date(2024, 1, 1))], DAYS), path, "date_kr")
    tables.overwrite_table(spark.read.parquet(path).withColumn("id", F.col("id") + 1), path, "date_kr")
    assert rows(spark.read.parquet(path), "id") == [(2,)]


def test_sharded_scan_reads_one_day(spark, tmp_path, rows):
    for suffix in ("20221010", "20221011"):
        spark.createDataFrame([(suffix,)], "v STRING").write.parquet(str(tmp_path / "e" / f"suffix={suffix}"))
    got = scans.scan_shard(spark, str(tmp_path / "e"), dt.date(2022, 10, 10), "v STRING")
    assert rows(got, "v") == [("20221010",)]
    assert "PartitionFilters: [isnotnull(suffix" in got._jdf.queryExecution().executedPlan().toString()


def test_trailing_scan_prunes_partitions(spark, tmp_path, rows):
    path, day = str(tmp_path / "p"), dt.date(2024, 1, 5)
    tables.overwrite_table(spark.createDataFrame([(i, dt.date(2024, 1, i)) for i in range(1, 8)], DAYS), path, "date_kr")
    got = scans.scan_trailing(spark.read.parquet(path), day)
    assert rows(got, "id") == [(4,), (5,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_kr" in plan and "PushedFilters: []" in plan
    assert rows(scans.scan_since(spark.read.parquet(path), dt.date(2024, 1, 6)), "id") == [(6,), (7,)]


def test_search_targets(spark, tmp_path, rows):
    seed = tmp_path / "seed.json"
    seed.write_text('[{"h3_l7": "a", "lat": 1.0, "lon": 2.0}]')
    table = str(tmp_path / "forecast")
    args = (spark, table, str(seed), schemas.SEARCH_TARGETS)
    assert rows(scans.search_targets(*args)) == [("a", 1.0, 2.0)]
    spark.createDataFrame([("b", 3.0, 4.0, 1), ("b", 3.0, 4.0, 2)], "h3_l7 STRING, lat DOUBLE, lon DOUBLE, x INT").write.parquet(table)
    assert rows(scans.search_targets(*args)) == [("b", 3.0, 4.0)]
    assert not scans.table_exists(spark, "no_such_table")


def test_sql_parameters_are_values(spark, rows):
    got = scans.run_sql(spark, "SELECT :name AS name, date_sub(:day, 1) AS day", name="x' OR 1=1", day=dt.date(2024, 1, 2))
    assert rows(got) == [("x' OR 1=1", dt.date(2024, 1, 1))]


def test_quality_rows(spark, rows):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 1)), (1, dt.date(2024, 1, 2))], DAYS)
    got = quality.value_check_by_day(df, F.count_distinct("id"), 1, "ids")
    assert rows(got, "date_kr", "observed", "passed") == [(dt.date(2024, 1, 1), "2", False), (dt.date(2024, 1, 2), "1", True)]
    assert quality.is_day_loaded(df, dt.date(2024, 1, 1)) and not quality.is_day_loaded(df, dt.date(2024, 1, 3))


def test_users(spark):
    user = {"id": 1, "external_id": "", "role": "agent", "role_type": None, "last_login_at": None,
            "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-01T00:00:00Z"}
    pages = spark.createDataFrame([(json.dumps({"page": 1, "users": [user]}),)], "t STRING").select(
        F.from_json("t", USERS.page_schema).alias("p")
    ).select("p.*")
    [row] = USERS.normalise(pages).collect()
    assert (row.external_id, row.role, row.role_type, row.last_login_at) == (None, "agent", None, None)
    assert staging_path(spark, "x").rsplit("/", 1)[1].startswith("x-")


def test_upsert_keeps_columns_that_the_source_lacks(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    stamp = dt.datetime(2024, 1, 1)
    first = spark.createDataFrame([(1, "a", 10, stamp), (2, "b", 20, stamp)], "id INT, v STRING, extra INT, created_at TIMESTAMP")
    tables.upsert_table(first, path, "created_at")
    second = spark.createDataFrame([(2, None, stamp, "n"), (3, "c", stamp, "m")], "id INT, v STRING, created_at TIMESTAMP, added STRING")
    for _ in range(2):
        assert tables.upsert_table(second, path, "created_at") == "merged"
    got = spark.read.option("mergeSchema", "true").parquet(path)
    assert rows(got, "id", "v", "extra", "added") == sorted([(1, "a", 10, None), (2, None, 20, "n"), (3, "c", None, "m")], key=repr)


def test_upsert_refuses_two_rows_of_one_key(spark, tmp_path):
    twice = batch(spark, [(1, "a", "2024-01-01"), (1, "b", "2024-01-01")])
    with pytest.raises(ValueError, match="several rows"):
        tables.upsert_table(twice, str(tmp_path / "t"), "created_at")


def test_merge_is_safe_for_null_keys_and_null_days(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    first = batch(spark, [(1, "h1", None), (None, "n", None), (2, "b", "2024-01-01")])
    tables.upsert_table(first, path, "created_at", day_in_key=True)
    again = batch(spark, [(None, "n2", None), (3, "c", "2024-01-01")])
    for _ in range(2):
        tables.upsert_table(again, path, "created_at", day_in_key=True)
    assert rows(spark.read.parquet(path), "id", "v") == sorted([(1, "h1"), (None, "n2"), (2, "b"), (3, "c")], key=repr)


def test_writers_of_one_day_grow_with_its_bytes(spark, tmp_path):
    def files(name, n):
        text = F.sha2(F.col("id").cast("string"), 512)
        df = spark.range(0, n, 1, 16).select("id", text.alias("v"), F.lit(dt.date(2024, 1, 1)).alias("date_kr"))
        tables.overwrite_days(df, str(tmp_path / name), "date_kr")
        return len(list((tmp_path / name / "date_kr=2024-01-01").glob("*.parquet")))

    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        assert files("light", 1_000) == 1
        assert files("heavy", 400_000) > 8
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_refresh_of_an_emptied_table(spark, tmp_path):
    path = str(tmp_path / "t")
    day = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "id INT, date_kr DATE")
    tables.overwrite_day(day, path, dt.date(2024, 1, 1))
    tables.overwrite_day(day.limit(0), path, dt.date(2024, 1, 1))
    assert tables.refresh_day(day, path, dt.date(2024, 1, 1)) == "loaded"
