"""Landing, tables, marts on stored data, archive, seeds and the file stream."""

import json
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from layerwright.plans import contracts, serving
from layerwright.plans import marts as m
from layerwright.session import cut_lineage, fresh_path, shared_folder
from layerwright.sources import archive, raw, seeds, tables
from layerwright.streaming.landing import follow_landing


def new_database(spark):
    name = f"db_{uuid.uuid4().hex}"
    raw.create_raw_tables(spark, name)
    return name


@pytest.fixture()
def database(spark):
    return new_database(spark)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def link(kind, number):
    return {"url": f"https://x/{kind}/{number}/"}


def entity(name, height, types, stats, past=(), moves=(1, 1, 2)):
    return {
        "name": name,
        "height": height,
        "weight": 60,
        "stats": [{"base_stat": v, "stat": {"name": k}, "effort": 0} for k, v in stats.items()],
        "types": [{"slot": i + 1, "type": {"name": t}} for i, t in enumerate(types)],
        "past_types": [
            {"generation": link("generation", g), "types": [{"slot": 1, "type": {"name": t}}]}
            for g, t in past
        ],
        "past_stats": [
            {
                "generation": link("generation", 1),
                "stats": [{"base_stat": 65, "stat": {"name": "special"}}],
            }
        ],
        "moves": [{"move": link("move", n)} for n in moves],
    }


FULL = {
    "hp": 1,
    "attack": 2,
    "defense": 3,
    "special-attack": 4,
    "special-defense": 5,
    "speed": 6,
}


def landed(spark, *docs, date="2024-01-01T00:00:00+00:00", batch="b1"):
    data = [(i, date, batch, p if isinstance(p, str) else json.dumps(p)) for i, p in docs]
    return spark.createDataFrame(data, "id bigint, fetch_date string, batch_id string, payload string")


@pytest.fixture()
def filled(spark):
    """Raw tables of its own for a test that adds to them."""
    return fill(spark)


@pytest.fixture(scope="module")
def standing(spark):
    """The same raw tables, shared by the tests that only read them."""
    return fill(spark)


def fill(spark):
    """The raw tables with a few rows of every kind."""
    database = new_database(spark)

    def land(name, *docs, **stamp):
        raw.land(spark, database, name, landed(spark, *docs, **stamp))

    land(
        "pokemons",
        (1, entity("leaf", 7, ["grass", "poison"], FULL)),
        (35, entity("fay", 6, ["fairy"], {**FULL, "speed": 60}, past=[(3, "odd"), (5, "normal")])),
        (4, entity("ember", 6, ["fire"], {k: v for k, v in FULL.items() if k != "hp"})),
        (9, '{"name": '),
    )
    species = [{"name": n, **link("species", i)} for i, n in ((1, "leaf"), (4, "ember"), (35, "fay"))]
    land("pokemon_catalogue", (None, {"id": 1, "pokemon_species": species, "extra": 1}))
    land("pokemon_catalogue", (None, {"id": 2, "pokemon_species": []}))
    names = [{"name": "Gen I", "language": {"name": "en"}}, {"name": "G1", "language": {"name": "fr"}}]
    land("generations", (None, {"id": 1, "name": "gen-i", "names": names, "moves": [1]}))
    land(
        "version_groups",
        (
            None,
            {
                "id": 1,
                "name": "red-blue",
                "generation": link("generation", 1),
                "versions": [{"name": "red", **link("version", 1)}, {"name": "blue", **link("version", 2)}],
            },
        ),
    )
    move = {"pp": 5, "priority": 0, "type": {"name": "fire"}, "damage_class": {"name": "special"}}
    land(
        "moves",
        (1, {"id": 1, "name": "m1", "power": None, "accuracy": None, **move, "generation": link("g", 1)}),
        (2, {"id": 2, "name": "m2", "power": 90, "accuracy": 100, **move, "generation": link("g", 2)}),
    )
    text = [
        {"flavor_text": "old", "language": {"name": "en"}},
        {"flavor_text": "new\fline\nend", "language": {"name": "en"}},
        {"flavor_text": "fin", "language": {"name": "fr"}},
    ]
    land(
        "pokemon_species",
        (
            1,
            {
                "flavor_text_entries": text,
                "genera": [{"genus": "Seed", "language": {"name": "en"}}],
                "is_legendary": False,
                "is_mythical": False,
                "is_baby": False,
                "color": {"name": "green"},
                "habitat": None,
                "evolves_from_species": None,
            },
        ),
        (
            35,
            {
                "flavor_text_entries": text[2:],
                "genera": [],
                "is_legendary": True,
                "is_mythical": False,
                "is_baby": True,
                "color": {"name": "pink"},
                "habitat": {"name": "cave"},
                "evolves_from_species": {"name": "kid", **link("species", 173)},
            },
        ),
    )
    return database


def views(spark, database, **options):
    return m.Views({name: spark.table(f"{database}.{name}") for name in raw.RAW_TABLES}, **options)


# ---- raw -----------------------------------------------------------------------------------------


def test_raw_tables_are_created_once(spark, database):
    raw.create_raw_tables(spark, database)
    created = {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}
    assert created == set(raw.RAW_TABLES)
    assert spark.table(f"{database}.moves").dtypes[1] == ("fetch_date", "timestamp_ntz")


def test_landing_guards_and_quarantine(spark, filled):
    table = f"{filled}.pokemons"
    assert spark.table(table).count() == 3
    assert spark.table(f"{table}_quarantine").select("id").collect()[0].id == 9
    raw.land(spark, filled, "pokemons", landed(spark, (1, {"name": "again"}), (5, {"name": "new"})))
    assert rows(spark.table(table).select("id")) == [(1,), (35,), (4,), (5,)]


def test_catalogue_landing_fills_the_lookup_and_cuts_the_payload(spark, standing):
    assert rows(spark.table(f"{standing}.pokemon_ids")) == [(1, 1), (35, 1), (4, 1)]
    payload = json.loads(spark.table(f"{standing}.pokemon_catalogue").where("payload LIKE '%leaf%'").first().payload)
    assert set(payload) == {"id", "pokemon_species"}


def test_stamp_and_read_landed(spark, tmp_path):
    df = raw.stamp(spark.range(2), "2024-01-01", "b")
    assert rows(df) == [(0, "2024-01-01", "b"), (1, "2024-01-01", "b")]
    df.withColumn("payload", F.lit("{}")).write.json(str(tmp_path / "in"))
    assert raw.read_landed(spark, str(tmp_path / "in")).count() == 2


# ---- models on landed rows -----------------------------------------------------------------------


def test_views(spark, standing):
    v = views(spark, standing)
    assert rows(v["stg_generations"].drop("fetch_date")) == [(1, "gen-i", "Gen I")]
    assert rows(v["stg_version_groups"].select("version_id", "version_name", "poke_gen")) == [
        (1, "red", 1),
        (2, "blue", 1),
    ]
    assert rows(v["stg_pokemons"].select("poke_gen", "poke_id", "poke_name", "height", "weight")) == [
        (1, 1, "leaf", 0.7, 6.0),
        (1, 35, "fay", 0.6, 6.0),
        (1, 4, "ember", 0.6, 6.0),
    ]
    assert v["stg_pokemons"].first().fetch_date == datetime(2024, 1, 1)
    species = {r.poke_id: r for r in v["stg_pokemon_species"].collect()}
    assert species[1].description == "new line end"
    assert species[1].evolves_from_id is None and species[1].habitat is None
    assert species[35].description is None and species[35].genus is None
    assert (species[35].evolves_from_id, species[35].is_legendary) == (173, True)
    assert rows(v["int_pokemon_moves"].where("poke_id = 1").select("move_id")) == [(1,), (2,)]
    assert rows(v["int_past_stats"].where("poke_id = 1").select("poke_gen", "stat_name", "stat_value")) == [
        (1, "special", 65)
    ]
    history = v["int_type_history"].where("poke_id = 35")
    assert rows(history.select("type", "valid_from_gen", "valid_to_gen")) == [
        ("fairy", 6, None),
        ("normal", 4, 5),
        ("odd", 1, 3),
    ]
    special = v["int_stats_history"].where("poke_id = 35 AND stat = 'special'")
    assert rows(special.select("valid_from_gen", "valid_to_gen")) == [(1, 1)]


def entity_batch(spark, database, poke_id, hp, date):
    later = landed(spark, (poke_id, entity("leaf", 9, ["grass"], {**FULL, "hp": hp})), date=date, batch=date)
    good, _ = raw.prepare(later, "pokemons")
    tables.append(good, f"{database}.pokemons")


def test_ranks_are_kept_and_mended_after_a_lost_load(spark, filled, monkeypatch):
    """A later load ranks its batch only; one that was lost before the ranks makes the next rank all."""
    target = f"{filled}_marts"
    names = ["mart_pokemons", "mart_stats"]
    m.load_marts(views(spark, filled), target, names=names)
    taken = []
    for name in ("load_all", "load_changes"):
        monkeypatch.setattr(
            m.ranks, name, lambda *a, name=name, real=getattr(m.ranks, name), **k: taken.append(name) or real(*a, **k)
        )

    def check():
        loaded = m.loaded_marts(spark, target)
        assert rows(loaded[m.STRONGEST]) == rows(m.strongest(loaded["mart_pokemons"], loaded["mart_stats"]))
        assert loaded[m.STRONGEST].columns[-2:] == ["rank", "tier"]

    entity_batch(spark, filled, 1, 90, "2024-03-01T00:00:00")
    m.load_marts(views(spark, filled), target, names=names)
    check()
    entity_batch(spark, filled, 77, 20, "2024-03-02T00:00:00")
    with monkeypatch.context() as patch:
        patch.setattr(m, "_load_ranks", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            m.load_marts(views(spark, filled), target, names=names)
    entity_batch(spark, filled, 4, 200, "2024-03-03T00:00:00")
    m.load_marts(views(spark, filled), target, names=names)
    check()
    m.load_marts(views(spark, filled), target, names=["mart_stats"])
    check()
    m.load_marts(views(spark, filled), target, names=names, full_refresh=True)
    check()
    assert taken == ["load_changes", "load_all", "load_changes", "load_all"]


def test_newest_fetch_is_kept(spark, filled):
    later = landed(spark, (1, entity("leaf2", 8, ["grass"], FULL)), date="2024-03-01T00:00:00", batch="b2")
    good, _ = raw.prepare(later, "pokemons")
    tables.append(good, f"{filled}.pokemons")
    assert views(spark, filled)["stg_pokemons"].where("poke_id = 1").collect()[0].poke_name == "leaf2"
    assert views(spark, filled, all_fetches=True)["stg_pokemons"].where("poke_id = 1").count() == 2


def test_marts_first_and_incremental_load(spark, filled):
    starters = spark.createDataFrame([(1, 1), (1, 4)], seeds.STARTERS)
    target = f"{filled}_marts"
    m.load_marts(views(spark, filled), target, starters)
    loaded = m.loaded_marts(spark, target)
    assert len(loaded) == 12
    stats = {r.poke_id: r.total_stat_points for r in loaded["mart_stats"].collect()}
    assert stats == {1: 21, 4: None, 35: 75}
    ranked = {r.poke_id: (r["rank"], r.tier) for r in loaded["mart_strongest_pokemons"].collect()}
    assert ranked == {35: (1, "C"), 1: (2, "F"), 4: (3, "S")}
    assert rows(loaded["mart_strongest_starters"].select("poke_id", "rank")) == [(1, 1), (4, 2)]

    later = landed(spark, (1, entity("leaf", 9, ["grass"], {**FULL, "hp": 50})), date="2024-03-01T00:00:00")
    good, _ = raw.prepare(later, "pokemons")
    tables.append(good, f"{filled}.pokemons")
    m.load_marts(views(spark, filled), target, starters)
    loaded = m.loaded_marts(spark, target)
    # the second type slot of entity 1 is gone: all its rows were replaced
    assert rows(loaded["mart_types"].select("poke_id", "slot")) == [(1, 1), (35, 1), (4, 1)]
    assert {r.poke_id: r.total_stat_points for r in loaded["mart_stats"].collect()}[1] == 70
    assert loaded["mart_pokemons"].count() == 3

    m.load_marts(views(spark, filled), target, full_refresh=True)
    assert m.loaded_marts(spark, target)["mart_stats"].count() == 3


def test_mark_from_source_skips_a_batch_in_between(spark, database):
    """Two batches arrive between runs: the source mark takes the newest, the target mark both."""

    def source(*found):
        return spark.createDataFrame(
            [(datetime(2024, 1, d), k, v) for d, k, v in found], "fetch_date timestamp_ntz, k int, v string"
        )

    first = source((1, 1, "a"))
    later = source((1, 1, "a"), (2, 2, "b"), (3, 3, "c"))
    for mark, expected in (("source", [(1, "a"), (3, "c")]), ("target", [(1, "a"), (2, "b"), (3, "c")])):
        name = f"{database}.mart_{mark}"
        for batch in (first, later):
            tables.load_mart(batch, name, "k", ["k", "v"], mark_from=mark)
        assert rows(spark.table(name)) == expected
    with pytest.raises(ValueError):
        tables.load_mart(later, f"{database}.other", "k", ["k", "v"], mark_from="x")


def test_bucketed_load_rewrites_only_touched_buckets(spark, database):
    """Files of a bucket the batch does not touch stay where they are."""

    def source(*found):
        return spark.createDataFrame(
            [(datetime(2024, 1, d), k, v) for d, k, v in found], "fetch_date timestamp_ntz, k int, v string"
        )

    name = f"{database}.bucketed"
    first = [(1, k, "old") for k in range(200)]
    tables.load_mart(source(*first), name, "k", ["k", "v"], buckets=8)
    files = spark.table(name).select("key_bucket", F.input_file_name().alias("f")).distinct()
    before = {r.f for r in files.collect()}
    tables.load_mart(source(*first, (2, 5, "new"), (2, 5, "newer"), (2, 999, "x")), name, "k", ["k", "v"], buckets=8)
    expected = [(k, "old") for k in range(200) if k != 5] + [(5, "new"), (5, "newer"), (999, "x")]
    assert rows(spark.table(name).select("k", "v")) == sorted(expected, key=str)
    after = spark.table(name).select("key_bucket", F.input_file_name().alias("f")).distinct()
    touched = {r.key_bucket for r in spark.table(name).where("k IN (5, 999)").collect()}
    kept = {r.f for r in after.collect() if r.key_bucket not in touched}
    assert kept <= before and 0 < len(touched) <= 2


    # a full refresh drops what the source no longer holds, whole buckets included
    tables.load_mart(source((1, 5, "z")), name, "k", ["k", "v"], buckets=8, full_refresh=True)
    assert rows(spark.table(name).select("k", "v")) == [(5, "z")]
    tables.load_mart(source(), name, "k", ["k", "v"], buckets=8)
    assert rows(spark.table(name).select("k", "v")) == [(5, "z")]
    tables.load_mart(source(), f"{name}_empty", "k", ["k", "v"], buckets=8)
    tables.load_mart(source((1, 1, "a")), f"{name}_empty", "k", ["k", "v"], buckets=8)
    assert rows(spark.table(f"{name}_empty").select("k", "v")) == [(1, "a")]


def test_replace_table_may_read_itself(spark, database):
    name = f"{database}.t"
    tables.replace_table(spark.range(4), name)
    tables.replace_table(spark.table(name).where("id > 0"), name)
    assert rows(spark.table(name)) == [(1,), (2,), (3,)]


def test_contract_report(spark, standing):
    v = views(spark, standing)
    live = m.LiveMarts(v)
    models = {n: v[n] for n in ("stg_pokemons", "int_stats", "int_types", "stg_move_details")}
    models.update(live.some("mart_types", "mart_strongest_pokemons", "mart_version_groups"))
    models.update(live.some("mart_version_group_versions"))
    found = {(r.model, r["check"], r.columns): r.failures for r in contracts.report(models).collect()}
    failing = {key for key, failures in found.items() if failures}
    assert failing == {
        ("int_stats", "not_null", "hp"),
        ("int_stats", "all_stats_present", ",".join(m.STATS)),
        # three rows: the first has percent rank 0.5
        ("mart_strongest_pokemons", "first_is_top_tier", "tier"),
    }
    assert found[("mart_version_group_versions", "relationships", "version_group_id")] == 0


def test_declared_checks_are_complete():
    counted = sum(len(columns) for columns in contracts.NOT_NULL.values())
    assert counted == 107 and len(contracts.UNIQUE) == 21


def test_freshness_report(spark, standing):
    tables_by_name = {n: spark.table(f"{standing}.{n}") for n in contracts.FRESHNESS_DAYS}
    report = contracts.freshness_report(tables_by_name, datetime(2024, 1, 20))
    found = {r.source: r.status for r in report.collect()}
    assert found["pokemons"] == found["pokemon_species"] == "warn"
    assert found["moves"] == found["pokemon_catalogue"] == "pass"


def test_sql_over_registered_marts(spark, standing):
    live = m.LiveMarts(views(spark, standing))
    spark.range(3).createOrReplaceTempView("mart_types")
    found = serving.run_sql(live.some("mart_types"), "SELECT poke_id FROM mart_types WHERE type = :t", t="fire")
    assert rows(found) == [(4,)]
    assert spark.table("mart_types").count() == 3  # a view of that name is as it was
    spark.catalog.dropTempView("mart_types")
    with pytest.raises(Exception):
        serving.run_sql(live.some("mart_types"), "SELECT nothing FROM mart_types")
    assert not any(t.isTemporary for t in spark.catalog.listTables())


def test_card_and_lists(spark, standing):
    starters = spark.createDataFrame([(1, 1)], seeds.STARTERS)
    live = m.LiveMarts(views(spark, standing), starters)
    card = serving.card(live, 1).first()
    assert (card.gen_name, card.primary_type, card.secondary_type) == ("Gen I", "grass", "poison")
    assert (card.is_starter, card.is_legendary) == (True, False)
    assert rows(serving.legendary_ids(live)) == [(35,)]
    assert rows(serving.starter_ids(live)) == [(1,)]
    assert [r.move_name for r in serving.moves_of(live, 35).collect()] == ["m1", "m2"]
    assert [r.move_name for r in serving.learnable_moves_by_power(live, "FAY").collect()] == ["m2", "m1"]


# ---- archive, seeds, shared folder ---------------------------------------------------------------


def test_archive_round_trip(spark, database, tmp_path):
    frames = {"a": spark.range(5), "none": spark.range(0)}
    report = archive.export_archive(spark, frames, str(tmp_path))
    assert rows(report) == [("a", 5, 5, "OK"), ("none", 0, 0, "SKIPPED")]
    for _ in range(2):
        seeded = archive.seed_from_archive(spark, database, {"a": str(tmp_path / "a.parquet")})
        assert rows(seeded) == [("a", 5, 5, "OK")]
    assert spark.table(f"{database}.a").count() == 5


def test_seed_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_bytes("﻿poke_id,is_legendary\n144,TRUE\n".encode())
    assert rows(seeds.read_seed(spark, str(path), seeds.LEGENDARIES)) == [(144, True)]


def test_shared_folder_is_the_session_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert cut_lineage(spark.range(3)).count() == 3


# ---- stream --------------------------------------------------------------------------------------


def test_follow_landing_reads_each_file_once(spark, database, tmp_path):
    folder, progress = tmp_path / "in", str(tmp_path / "progress")
    folder.mkdir()
    refreshed = []

    def drop(name, *docs):
        lines = [
            json.dumps({"id": i, "fetch_date": "2024-01-01T00:00:00", "batch_id": "b", "payload": p})
            for i, p in docs
        ]
        (folder / name).write_text("\n".join(lines))

    def run():
        follow_landing(
            spark, database, "moves", str(folder), progress, lambda: refreshed.append(1)
        ).awaitTermination(60)
        return rows(spark.table(f"{database}.moves").select("id"))

    drop("one.json", (1, "{}"), (2, "{}"))
    assert run() == [(1,), (2,)]
    drop("two.json", (2, "{}"), (3, "{}"), (4, "{"))
    assert run() == [(1,), (2,), (3,)]
    assert run() == [(1,), (2,), (3,)]
    assert len(refreshed) == 2
    assert rows(spark.table(f"{database}.moves_quarantine").select("id")) == [(4,)]


# ---- layout, schema, superseded folders ----------------------------------------------------------


def keyed(spark, *found):
    rows = [(datetime(2024, 1, d), k, v) for d, k, v in found]
    return spark.createDataFrame(rows, "fetch_date timestamp_ntz, k int, v string")


def test_another_bucket_count_keeps_one_row_per_key(spark, database):
    name = f"{database}.rebucketed"
    tables.load_mart(keyed(spark, *[(1, k, "old") for k in range(100)]), name, "k", ["k", "v"], buckets=8)
    tables.load_mart(keyed(spark, *[(2, k, "new") for k in (1, 2, 3)]), name, "k", ["k", "v"], buckets=16)
    found = spark.table(name)
    assert found.count() == found.select("k").distinct().count() == 100
    assert rows(found.where("v = 'new'").select("k")) == [(1,), (2,), (3,)]
    assert found.agg(F.max(tables.BUCKET)).first()[0] > 7
    # without a count the stored one holds
    tables.load_mart(keyed(spark, (3, 50, "newer")), name, "k", ["k", "v"])
    assert spark.table(name).count() == 100 and tables.is_bucketed(spark, name)


def test_full_refresh_across_layouts_and_columns(spark, database):
    name = f"{database}.refreshed"
    tables.load_mart(keyed(spark, *[(1, k, "old") for k in range(100)]), name, "k", ["k", "v"], buckets=8)
    tables.load_mart(keyed(spark, (2, 1, "new")), name, "k", ["k", "v"], full_refresh=True)
    assert rows(spark.table(name).select("k", "v")) == [(1, "new")] and tables.is_bucketed(spark, name)
    tables.load_mart(keyed(spark, (2, 2, "new")), name, "k", ["k", "v"], full_refresh=True, buckets=0)
    assert rows(spark.table(name)) == [(2, "new")] and not tables.is_bucketed(spark, name)
    tables.load_mart(keyed(spark, (3, 3, "b")), name, "k", ["k", "v"], buckets=4)
    assert rows(spark.table(name).select("k")) == [(2,), (3,)] and tables.is_bucketed(spark, name)


def test_other_keys_or_columns_need_a_full_refresh(spark, database):
    name = f"{database}.checked"
    tables.load_mart(keyed(spark, (1, 1, "a")), name, "k", ["k", "v"])
    with pytest.raises(ValueError, match="keyed"):
        tables.load_mart(keyed(spark, (2, 1, "b")), name, "v", ["k", "v"])
    renamed = keyed(spark, (2, 1, "b")).withColumnRenamed("v", "w")
    with pytest.raises(ValueError, match="columns"):
        tables.load_mart(renamed, name, "k", ["k", "w"])
    tables.load_mart(renamed, name, "k", ["k", "w"], full_refresh=True)
    assert spark.table(name).columns == ["k", "w"] and rows(spark.table(name)) == [(1, "b")]


def test_replace_table_takes_new_columns(spark, database, tmp_path):
    name = f"{database}.shaped"
    tables.replace_table(spark.range(3), name)
    tables.replace_table(spark.range(3).selectExpr("id AS renamed", "'x' AS added"), name)
    assert rows(spark.table(name)) == [(0, "x"), (1, "x"), (2, "x")]
    spark.range(2).selectExpr("id AS other").write.parquet(str(tmp_path / "a.parquet"))
    report = archive.seed_from_archive(spark, database, {"shaped": str(tmp_path / "a.parquet")})
    assert rows(report) == [("shaped", 2, 2, "OK")] and spark.table(name).columns == ["other"]


def test_vacuum_removes_only_earlier_versions(spark, database):
    plain, split = f"{database}.plain", f"{database}.split"
    for _ in range(3):
        tables.replace_table(spark.range(5), plain)
    assert len(tables.vacuum(spark, plain)) == 2
    assert tables.vacuum(spark, plain) == [] and spark.table(plain).count() == 5
    tables.load_mart(keyed(spark, *[(1, k, "old") for k in range(50)]), split, "k", ["k", "v"], buckets=4)
    tables.load_mart(keyed(spark, (2, 1, "new")), split, "k", ["k", "v"])
    tables.vacuum(spark, split)
    assert spark.table(split).count() == 50
    assert rows(spark.table(split).where("v = 'new'").select("k")) == [(1,)]


# ---- landing again -------------------------------------------------------------------------------


def test_landing_again_adds_nothing(spark, filled):
    doc = entity("leaf", 7, ["grass"], FULL)
    batch = landed(spark, (50, doc), (50, doc), (None, doc), (51, "{"), (51, "{"), batch="b7")
    for _ in range(2):
        raw.land(spark, filled, "pokemons", batch)
    table = spark.table(f"{filled}.pokemons")
    assert table.where("id = 50").count() == 1
    bad = spark.table(f"{filled}.pokemons_quarantine").where("batch_id = 'b7'")
    assert rows(bad.select("id")) == [(51,), (None,)]


def test_refetches_land_where_asked_for(spark, filled):
    later = landed(spark, (1, entity("leaf2", 8, ["grass"], FULL)), date="2024-03-01T00:00:00", batch="b2")
    raw.land(spark, filled, "pokemons", later)
    assert views(spark, filled)["stg_pokemons"].where("poke_id = 1").first().poke_name == "leaf"
    for _ in range(2):
        raw.land(spark, filled, "pokemons", later, guard="fetch")
    assert views(spark, filled)["stg_pokemons"].where("poke_id = 1").first().poke_name == "leaf2"
    assert spark.table(f"{filled}.pokemons").where("id = 1").count() == 2
    with pytest.raises(ValueError):
        raw.land(spark, filled, "pokemons", later, guard="x")


def test_payload_id_is_a_column(spark, filled):
    assert rows(spark.table(f"{filled}.pokemon_catalogue").select("id")) == [(1,), (2,)]
    raw.land(spark, filled, "generations", landed(spark, (None, {"name": "no id"})))
    assert spark.table(f"{filled}.generations").count() == 1
    assert spark.table(f"{filled}.generations_quarantine").count() == 1


# ---- incremental loads read only what is new -----------------------------------------------------


def test_second_load_pushes_the_mark_to_the_scan(spark, filled, monkeypatch):
    target = f"{filled}_pushed"
    m.load_marts(views(spark, filled), target)
    later = landed(spark, (1, entity("leaf", 9, ["grass"], {**FULL, "hp": 50})), date="2024-03-01T00:00:00", batch="b2")
    raw.land(spark, filled, "pokemons", later, guard="fetch")
    plans = []
    narrowed = m.Views.since

    def kept(self, table, mark):
        found = narrowed(self, table, mark)
        plans.append((table, found._raw[table]._jdf.queryExecution().executedPlan().toString()))
        return found

    monkeypatch.setattr(m.Views, "since", kept)
    m.load_marts(views(spark, filled), target)
    assert {table for table, _ in plans} == {"generations", "moves", "pokemons", "pokemon_species", "version_groups"}
    assert all("GreaterThanOrEqual(fetch_date" in plan for _, plan in plans)
    stats = {r.poke_id: r.total_stat_points for r in spark.table(f"{target}.mart_stats").collect()}
    assert stats[1] == 70 and len(stats) == 3
    assert rows(spark.table(f"{target}.mart_types").where("poke_id = 1").select("slot")) == [(1,)]


def test_marts_parse_the_entities_once(spark, filled):
    stored = views(spark, filled).stored()
    for name in ("stg_pokemons", "int_stats_total", "int_types", "int_pokemon_moves", "int_past_types"):
        plan = stored[name]._jdf.queryExecution().analyzed().toString()
        if name != "stg_pokemons":  # whose catalogue is another payload
            assert "from_json" not in plan
    assert stored._typed is not None


class Lost(Exception):
    pass


def faults(spark, monkeypatch, load, check):
    """Run ``load`` again and again, lost before one more of its catalog statements each time."""
    sql, at = type(spark).sql, 0
    while True:
        left = [at]

        def lost(self, query, *args, **kwargs):
            if query.split()[0] in ("CREATE", "ALTER", "DROP"):
                if not left[0]:
                    raise Lost(query)
                left[0] -= 1
            return sql(self, query, *args, **kwargs)

        with monkeypatch.context() as patched:
            patched.setattr(type(spark), "sql", lost)
            try:
                load()
                return at
            except Lost:
                pass
        check()
        at += 1


def test_a_lost_load_leaves_old_or_new_rows_whole(spark, database, monkeypatch):
    """Lost between any two statements: buckets never mix, and a layout change never leaves no table."""
    name = f"{database}.switched"
    old = [(k, "old") for k in range(60)]
    tables.load_mart(keyed(spark, *[(1, k, "old") for k in range(60)]), name, "k", ["k", "v"], buckets=8)
    new = [(2, k, "new") for k in range(0, 60, 2)]
    expected = [(k, "old" if k % 2 else "new") for k in range(60)]
    seen = []

    def whole(*versions):
        found = rows(spark.table(name).select("k", "v"))
        seen.append(versions.index(found))

    ordered = [sorted(v, key=str) for v in (old, expected)]
    statements = faults(
        spark,
        monkeypatch,
        lambda: tables.load_mart(keyed(spark, *new), name, "k", ["k", "v"]),
        lambda: whole(*ordered),
    )
    assert statements >= 3 and seen[0] == 0 and seen == sorted(seen)
    whole(ordered[1])
    renamed = keyed(spark, (3, 1, "b")).withColumnRenamed("v", "w")
    states = []

    def either():
        frame = spark.table(name).drop(tables.BUCKET)
        states.append((tuple(frame.columns), frame.count()))

    faults(
        spark,
        monkeypatch,
        lambda: tables.load_mart(renamed, name, "k", ["k", "w"], full_refresh=True, buckets=0),
        either,
    )
    assert set(states) <= {(("k", "v"), 60), (("k", "w"), 1)} and states[0] == (("k", "v"), 60)
    assert rows(spark.table(name)) == [(1, "b")] and not tables.is_bucketed(spark, name)


def test_versions_leave_the_catalog(spark, database):
    """The newest version and the one before stay; frames planned on the latter can still be read."""
    name = f"{database}.kept"
    tables.load_mart(keyed(spark, *[(1, k, "a") for k in range(20)]), name, "k", ["k", "v"], buckets=4)
    planned = spark.table(name).select("k", "v")
    for day in (2, 3):
        tables.load_mart(keyed(spark, (day, 1, f"b{day}")), name, "k", ["k", "v"])
        if day == 2:
            assert rows(planned) == sorted([(k, "a") for k in range(20)], key=str)
    assert len(tables._versions(spark, name)) == 2
    tables.vacuum(spark, name)
    assert tables._versions(spark, name) == [tables.current(spark, name)]
    assert spark.table(name).count() == 20 and spark.table(name).where("v = 'b3'").count() == 1


def test_a_landing_reads_only_batches_that_may_hold_its_ids(spark, database):
    """Folders of other batches are skipped, and nothing is read where all ids are new."""
    for at in range(4):
        docs = [(at * 100 + i, {"name": f"n{i}"}) for i in range(20)]
        raw.land(spark, database, "pokemons", landed(spark, *docs, batch=f"b{at}"))
    target = f"{database}.pokemons"
    assert spark.table(target).count() == 80

    def read(*ids, **options):
        rows = spark.createDataFrame([(i, "b9") for i in ids], "id long, batch_id string")
        found = raw.held_batches(spark, target, rows, **options)
        return found and {f.split("batch_id=")[1].split("/")[0] for f in found.select("id").inputFiles()}

    assert read(5, 310, 9999) == {"b0", "b3"}
    assert read(7777, 8888) is None
    assert read(5, only_own=True) is None
    plan = raw.held_batches(spark, target, spark.createDataFrame([(105, "b9")], "id long, batch_id string"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "coalesce(batch_id" in text
    raw.land(spark, database, "pokemons", landed(spark, (105, {"name": "x"}), (900, {"name": "y"}), batch="b9"))
    assert spark.table(target).where("id = 105").count() == 1 and spark.table(target).where("id = 900").count() == 1


def test_every_bit_of_a_batch_is_found(spark):
    rows = spark.range(3000).select(F.col("id") * 7919, F.lit("b").alias("batch_id")).toDF("id", "batch_id")
    bitmaps = raw._bitmaps(rows)
    asked = rows.union(rows.selectExpr("id + 1", "batch_id")).withColumn("bit", raw._key_bit())
    met = asked.select("id", F.bitmap_bucket_number("bit").alias("bucket"), F.bitmap_bit_position("bit").alias("p"))
    met = met.join(bitmaps, "bucket").where(raw._has_bit("bits", "p"))
    found = {r.id for r in met.select("id").collect()}
    every = {i * 7919 for i in range(3000)}
    assert every <= found and len(found - every) < 5


def test_rows_without_a_batch_land_once(spark, database):
    for _ in range(2):
        rows = landed(spark, (1, {"name": "a"}), (2, {"name": "b"})).withColumn("batch_id", F.lit(None).cast("string"))
        raw.land(spark, database, "pokemons", rows, guard="fetch")
        raw.land(spark, database, "moves", rows)
    assert spark.table(f"{database}.pokemons").count() == spark.table(f"{database}.moves").count() == 2


@pytest.mark.parametrize("batch", ["manual__2024-01-01T00:00:00+00:00", "a/b=c %41 'd'", "__x", "é #"])
def test_batch_ids_of_any_characters_land_once(spark, database, batch):
    given = landed(spark, (1, {"name": "a"}), (2, {"name": "b"}), batch=batch)
    for guard in ("id", "fetch", "fetch"):
        raw.land(spark, database, "pokemons", given, guard=guard)
    assert rows(spark.table(f"{database}.pokemons").select("id", "batch_id")) == [(1, batch), (2, batch)]


def landings(spark, database, days, guard="fetch"):
    for day, ids in days:
        docs = [(i, entity(f"n{i}-{day}", i + day, ["grass"], FULL)) for i in ids]
        raw.land(
            spark, database, "pokemons",
            landed(spark, *docs, date=f"2024-01-{day:02}T10:00:00+00:00", batch=f"run {day}: 'x'"), guard=guard,
        )


def test_mark_and_batch_come_from_the_catalog(spark, database, monkeypatch):
    landings(spark, database, [(1, range(5)), (2, range(3, 8)), (3, range(2))])
    found = raw.Landed(spark, database)
    whole = spark.table(f"{database}.pokemons")
    with monkeypatch.context() as patch:
        patch.setattr(raw.Landed, "__getitem__", lambda *_: pytest.fail("the mark reads the table"))
        assert found.newest("pokemons") == datetime(2024, 1, 3, 10)
        assert found.newest("moves") is None
    for mark, n_batches in ((datetime(2024, 1, 3, 10), 1), (datetime(2024, 1, 2), 2), (datetime(2025, 1, 1), 0)):
        some = found.since("pokemons", mark)
        assert rows(some) == rows(whole.where(F.col("fetch_date") >= F.lit(mark.isoformat()).cast("timestamp_ntz")))
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert ("PartitionFilters: [" in plan and "coalesce(batch_id" in plan) == bool(n_batches)
        read = {row[0] for row in some.select("_metadata.file_path").distinct().collect()} if n_batches else set()
        assert len({path.rsplit("/", 1)[0] for path in read}) == n_batches
    assert found.since("pokemons", None).count() == 12
    # no row, no file: only entries
    assert spark.table(f"{database}.pokemons_spans").inputFiles() == []
    assert len(raw.partitions(spark, f"{database}.pokemons_spans")) == 3


@pytest.mark.parametrize("lost", ["begun", "rows", "done", "forget"])
def test_a_lost_landing_leaves_a_true_mark(spark, database, monkeypatch, lost):
    landings(spark, database, [(1, range(4))])
    found = raw.Landed(spark, database)

    class Lost(Exception):
        pass

    def failing(function, when):
        def call(*args):
            if when(*args):
                raise Lost
            return function(*args)

        return call

    with monkeypatch.context() as patch:
        if lost == "rows":
            patch.setattr(raw.tables, "append", failing(raw.tables.append, lambda _, t: t.endswith(".pokemons")))
        elif lost == "forget":
            patch.setattr(raw, "_forget", failing(raw._forget, lambda *_: True))
        else:
            patch.setattr(raw, "_enter", failing(raw._enter, lambda *a: a[3] == lost))
        with pytest.raises(Lost):
            landings(spark, database, [(2, range(2, 6))])

    def agrees():
        spark.catalog.refreshTable(f"{database}.pokemons")
        whole = spark.table(f"{database}.pokemons")
        assert found.newest("pokemons") == whole.agg(F.max("fetch_date")).first()[0]
        for day in (1, 2, 3):
            mark = datetime(2024, 1, day, 9)
            late = whole.where(F.col("fetch_date") >= F.lit(mark.isoformat()).cast("timestamp_ntz"))
            assert rows(found.since("pokemons", mark)) == rows(late)

    agrees()
    landings(spark, database, [(2, range(2, 6))])
    agrees()
    assert found.newest("pokemons") == datetime(2024, 1, 2, 10)


def test_marts_over_landed_tables_equal_a_rebuild(spark, database):
    options = {"names": ["mart_stats", "mart_types"], "mark_from": "target"}
    target = f"{database}_marts"
    landings(spark, database, [(1, range(5))])
    m.load_marts(m.Views(raw.Landed(spark, database)), target, **options)
    landings(spark, database, [(2, range(3, 8)), (3, range(2))])
    # rows from elsewhere, under a batch of their own and without a span
    other = spark.table(f"{database}.pokemons").where("id = 7")
    tables.append(
        other.selectExpr("20 AS id", "TIMESTAMP_NTZ '2024-01-04 00:00:00' AS fetch_date", "'own' AS batch_id", "payload"),
        f"{database}.pokemons",
    )
    spark.catalog.refreshTable(f"{database}.pokemons")
    again = m.Views(raw.Landed(spark, database))
    assert again.newest("pokemons") == datetime(2024, 1, 4)
    m.load_marts(again, target, **options)
    for name in options["names"]:
        assert rows(spark.table(f"{target}.{name}")) == rows(m.mart(again, name))
