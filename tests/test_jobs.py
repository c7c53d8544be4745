"""Whole jobs over stored tables, and the contract of the entry file."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from wayfare.plans import jobs, report
from wayfare.sources import tables as S


@pytest.fixture(scope="module")
def data_dir(spark, tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("data"))
    S.write_persons(tables.persons(), f"{root}/persons")
    S.write_places(tables.places(), f"{root}/places")
    S.write_categories(tables.categories(), f"{root}/categories")
    S.write_location_visits(tables.location_visits(), f"{root}/location_visits")
    jobs.build_place_visits(spark, root, 7)
    jobs.build_stochastic_graphs(spark, root, 0.5, 0.5)
    jobs.build_ratings(spark, root, 100, 10)
    return root


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_tables_read_back(spark, tables, data_dir):
    assert rows(S.load_persons(spark, f"{data_dir}/persons")) == rows(tables.persons())
    places = S.load_places(spark, f"{data_dir}/places")
    assert dict(places.dtypes)["region_id"] == "bigint"
    assert rows(places.select("id", "region_id", "name")) == rows(tables.places().select("id", "region_id", "name"))
    assert rows(S.load_categories(spark, f"{data_dir}/categories").select("category_id", "category")) == rows(
        tables.categories()
    )
    visits = S.load_location_visits(spark, f"{data_dir}/location_visits")
    assert visits.count() == 1_000
    assert [r.year_month for r in visits.select("year_month").distinct().collect()] == ["202401"]


def test_facts_read_back(spark, data_dir, facts):
    stored = S.load_place_visits(spark, f"{data_dir}/place_visits")
    expected = facts[7].withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    assert stored.columns == expected.columns
    assert rows(stored) == rows(expected)


def test_one_region_set_reads_one_folder(spark, data_dir):
    part = jobs.load_graph(spark, data_dir, "region0_region1")
    assert part.count() > 0
    assert {f.split("region_set=")[1].split("/")[0] for f in part.inputFiles()} == {"region0_region1"} or (
        "PartitionFilters: [isnotnull(region_set" in part._jdf.queryExecution().executedPlan().toString()
    )
    vectors = S.load_region_sets(spark, data_dir, S.PLACE_RATING_VECTORS_TABLE, region_set="region1")
    assert set(vectors.columns) == {"person_id", "rating_vector", "region_set"}
    assert vectors.count() > 0


@pytest.fixture()
def some_sets(spark, tmp_path):
    root = str(tmp_path)
    S.write_region_sets(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "c")], "id long, region_set string"), root, "t")
    return root


def stored(spark, root):
    return rows(S.load_region_sets(spark, root, "t").select("id", "region_set"))


def test_replaced_sets_leave_the_others_alone(spark, some_sets):
    kept = S._file_names(spark, f"{some_sets}/t/region_set=a")
    new = spark.createDataFrame([("b", 7), ("d", 8)], "region_set string, id long")
    # c is to be replaced and has no rows any more; e never had any.
    S.replace_region_sets(new, some_sets, "t", ["b", "c", "d", "e"])
    assert stored(spark, some_sets) == [(1, "a"), (7, "b"), (8, "d")]
    assert S.stored_region_sets(spark, some_sets, "t") == ["a", "b", "d"]
    assert S._file_names(spark, f"{some_sets}/t/region_set=a") == kept


def test_replacing_twice_ends_the_same(spark, some_sets):
    new = spark.createDataFrame([(7, "b")], "id long, region_set string")
    for _ in range(2):
        S.replace_region_sets(new, some_sets, "t", ["b"])
    assert stored(spark, some_sets) == [(1, "a"), (3, "c"), (4, "c"), (7, "b")]


def test_rows_of_other_sets_raise_before_anything_goes(spark, some_sets):
    for wrong in ("a", None):
        new = spark.createDataFrame([(7, "b"), (8, wrong)], "id long, region_set string")
        with pytest.raises(Exception, match="not a set to replace"):
            S.replace_region_sets(new, some_sets, "t", ["b"])
    assert stored(spark, some_sets) == [(1, "a"), (2, "b"), (3, "c"), (4, "c")]


def test_a_new_table_and_an_empty_list_of_sets(spark, some_sets):
    S.replace_region_sets(spark.createDataFrame([(1, "x")], "id long, region_set string"), some_sets, "new", ["x"])
    assert S.stored_region_sets(spark, some_sets, "new") == ["x"]
    S.replace_region_sets(spark.createDataFrame([], "id long, region_set string"), some_sets, "t", [])
    assert len(stored(spark, some_sets)) == 4


def test_one_region_is_built_anew(spark, data_dir, tmp_path):
    """Only sets with the region change; what they hold equals a build of everything."""
    root = str(tmp_path / "copy")
    shutil.copytree(data_dir, root)
    names = (S.GRAPH_TABLE, S.PLACE_RATINGS_TABLE, S.CATEGORY_RATINGS_TABLE, S.CATEGORY_RATING_VECTORS_TABLE)
    old = {n: rows(S.load_region_sets(spark, root, n)) for n in names}
    jobs.build_stochastic_graphs(spark, root, 0.2, 0.8, regions=[2])
    jobs.build_ratings(spark, root, 3, 2, regions=[2])
    new = {n: rows(S.load_region_sets(spark, root, n)) for n in names}
    jobs.build_stochastic_graphs(spark, root, 0.2, 0.8)
    jobs.build_ratings(spark, root, 3, 2)
    for n in names:
        whole = rows(S.load_region_sets(spark, root, n))
        touched = lambda r: "region2" in r[-1].split("_")
        assert [r for r in new[n] if touched(r)] == [r for r in whole if touched(r)]
        assert [r for r in new[n] if not touched(r)] == [r for r in old[n] if not touched(r)]
        assert any(map(touched, whole)) and not all(map(touched, whole))


def test_lookups_read_few_rows(spark, tmp_path):
    """Of a set's million edges, a lookup of three persons reads their pages only."""
    root = str(tmp_path)
    edges = spark.range(1_000_000).select((F.col("id") % 20_011).alias("source_id"), (F.col("id") % 7 + 50_000).alias("target_id"), F.lit(0.5).alias("balanced_weight"))
    S.write_region_sets(edges.withColumn("region_set", F.lit("region1")), root, S.GRAPH_TABLE)
    stored = jobs.load_graph(spark, root, "region1")
    found = S.rows_with_ids(stored, ("source_id",), [5, 11_000, 999_999])
    assert found.count() == 100
    plan = found.select("source_id")._jdf.queryExecution().executedPlan()
    assert "EqualTo(source_id,5)" in plan.toString()
    assert rows_read(found.select("source_id")) < 200_000
    assert rows_read(S.rows_with_ids(stored, ("target_id",), [49_999]).select("target_id")) == 0


def rows_read(df):
    """Rows that the scan of a table hands on."""
    df = df.coalesce(1)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    if leaves.apply(0).nodeName().startswith("AdaptiveSparkPlan"):
        leaves = plan.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_factored_graphs_serve_the_same(spark, data_dir):
    jobs.build_factored_graphs(spark, data_dir)
    asked = ask(spark, (100_000, None), (100_001, 2), (999_999, None))
    whole, rejected = jobs.recommend_by_walk(spark, data_dir, asked, 0.05, 20, 5)
    derived, also = jobs.recommend_by_walk(spark, data_dir, asked, 0.05, 20, 5, betas=(0.5, 0.5))
    columns = ["person_id", "region_id", "id", F.round("probability", 10)]
    assert rows(derived.select(*columns)) == rows(whole.select(*columns)) and rows(also) == rows(rejected)
    read = S.load_graph_counts(spark, data_dir, [1])
    assert {(r.region_id, r.that_region_id) for r in read.collect()} == {(1, 1)}


def ask(spark, *found):
    return spark.createDataFrame(list(found), "person_id long, region_id long")


@pytest.mark.parametrize("how", ["walk", "neighbours"])
def test_recommendations(spark, data_dir, how):
    asked = ask(spark, (100_000, None), (100_001, 2), (999_999, None))
    if how == "walk":
        best, rejected = jobs.recommend_by_walk(spark, data_dir, asked, 0.05, 20, 5)
        score = "probability"
    else:
        best, rejected = jobs.recommend_by_neighbours(spark, data_dir, asked, 0.5, 0.5, 10, 5)
        score = "estimated_rating"
    got = best.collect()
    per_person = {p: [r for r in got if r.person_id == p] for p in (100_000, 100_001)}
    assert {len(found) for found in per_person.values()} == {5}
    assert {r.region_id for r in per_person[100_000]} == {0}
    assert {r.region_id for r in per_person[100_001]} == {2}
    assert all(r[score] > 0 and r.name.startswith("place-") for r in got)
    assert rows(rejected) == [(999_999, None, "unknown person")]


def test_walk_finds_the_known_best_places(spark, data_dir):
    """Person 100000 in regions 0 and 1, looking at region 1 from home region 0 and all places."""
    from wayfare.operators import walk

    asked = spark.createDataFrame([("region0_region1", 100_000)], "region_set string, person_id long")
    found, taken = walk.walk(jobs.load_graph(spark, data_dir), asked, 0.05, 20)
    assert [r.steps for r in taken.collect()] == [2]
    best = found.where("id between 40 and 139").orderBy(F.desc("probability")).limit(3).collect()
    assert [(r.id, round(r.probability, 6)) for r in best] == [(102, 0.040382), (92, 0.039915), (91, 0.030001)]


def test_deduplicate_job(spark, data_dir):
    places = S.load_places(spark, f"{data_dir}/places")
    confirmed = places.where("id = 40")
    jobs.deduplicate_places(spark, data_dir, confirmed, 1_000, 1)
    left = S.load_places(spark, f"{data_dir}/unique_places")
    assert 0 < left.count() < places.count()
    assert left.where("id = 40").count() == 1


def test_every_query_has_sql():
    import __spark_entry__ as entry

    assert set(report.all_queries()) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert len(report.all_queries()) >= 60


def partition_filters(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("PartitionFilters: [")[1].split("]")[0] for line in plan.splitlines() if "PartitionFilters: [" in line]


def test_jobs_read_only_the_region_sets_asked_for(spark, data_dir, monkeypatch):
    """What the jobs load is filtered by the names of the sets, in the scans of graph and ratings."""
    loaded = []
    load = S.load_region_sets

    def watched(spark, root, table, schema=None, region_set=None):
        loaded.append((table, region_set, load(spark, root, table, schema, region_set)))
        return loaded[-1][2]

    monkeypatch.setattr(S, "load_region_sets", watched)
    asked = ask(spark, (100_000, None), (100_001, 2))
    jobs.recommend_by_walk(spark, data_dir, asked, 0.05, 20, 5)
    jobs.recommend_by_neighbours(spark, data_dir, asked, 0.5, 0.5, 10, 5)
    assert [table for table, _, _ in loaded] == [S.GRAPH_TABLE, S.PLACE_RATINGS_TABLE, S.CATEGORY_RATINGS_TABLE]
    for _, names, df in loaded:
        assert names == ["region0", "region1_region2"]
        assert all("region0" in f and "region1_region2" in f for f in partition_filters(df))
        assert len(partition_filters(df)) == 1


def test_facts_decide_the_form_of_covisits(spark, tables, facts):
    """Facts of 30 days are cut by the seven-day interval, whoever builds the graph."""
    from wayfare.operators import edges, graph, region_sets

    sets = region_sets.all_region_sets(tables.places()).where("region_set = 'region0'")
    whole = graph.region_edges(facts[30], sets)["place_place"].count()
    inside = edges.place_similar_place_edges(facts[30].where("region_id = 0")).count()
    every_two = edges.place_similar_place_edges(facts[30].where("region_id = 0"), interval_days=30).count()
    assert whole == inside < every_two


def test_nothing_is_left_in_the_shared_folder(spark):
    import glob

    from wayfare import runtime

    kept = runtime._written.pop(spark.sparkContext.applicationId, [])
    runtime.materialize(spark.range(3))
    (path,) = runtime._written[spark.sparkContext.applicationId]
    assert glob.glob(path.removeprefix("file:"))
    assert runtime.release(spark) == 1
    assert not glob.glob(path.removeprefix("file:"))
    runtime._written[spark.sparkContext.applicationId] = kept


@pytest.mark.parametrize("name", sorted(report._queries))
def test_reports_equal_sql(spark, name):
    from checks.compare import compare, duck
    from checks.oracles import all_oracles

    sf_dir = "/root/testdata/sf0.001"
    result = report.all_queries()[name](spark, sf_dir)
    answer = duck(sf_dir).execute(all_oracles()[name])
    problem = compare(
        [tuple(r) for r in result.collect()], result.columns, answer.fetchall(), [d[0] for d in answer.description]
    )
    assert not problem
