"""Loads as one transaction."""

import glob

import pytest

from quayside.ml import train
from quayside.operators import constraints
from quayside.schema import TABLES
from quayside.sources.csv_load import ConstraintError
from quayside.sources.snapshot import ConflictError, Snapshot, loading_session, store_observed

FILES = {
    "regions": "a,b\nnorth,DE\nsouth,\\N\n",
    "suppliers": "a,b,c\nAcme,\\N,1\n",
    "branches": "a,b,c\nmain,2,x\n",
    "products": "a,b,c\npen,office,1.255\n",
    "customers": "a,b,c,d\nAda,\\N,1,2020-01-01\n",
    "orders": "a,b,c,d\n1,2021-01-01,new,5\n1,2021-01-02,new,6\n",
    "order_items": "a,b,c,d\n1,1,2,1.00\n2,1,1,1.00\n",
    "daily_production": "a,b,c,d\n1,1,2021-01-01,7\n",
}


@pytest.fixture
def files(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text)
    return folder


def counts(snapshot):
    return {name: df.count() for name, df in snapshot.tables().items()}


def test_a_failing_file_leaves_all_tables_as_they_were(spark, files, tmp_path):
    snapshot = Snapshot(spark, f"{tmp_path}/store")
    loaded = snapshot.load(str(files))
    assert [(x.table, x.rows) for x in loaded] == [(n, len(t.splitlines()) - 1) for n, t in FILES.items()]
    before = {name: sorted(map(tuple, df.collect()), key=str) for name, df in snapshot.tables().items()}
    assert set(before) == set(TABLES) and snapshot.tables()["products"].first().unit_cost.as_tuple().digits == (1, 2, 6)

    # every file is new, and the sixth one breaks a foreign key
    for name, text in FILES.items():
        (files / f"{name}.csv").write_text(text + text.splitlines()[1] + "\n")
    (files / "orders.csv").write_text("a,b,c,d\n99,2021-01-01,new,5\n\\N,\\N,new,5\n")
    folders = sorted(glob.glob(f"{tmp_path}/store/data/*/*"))
    with pytest.raises(ConstraintError, match=r"orders: not_null order_date \(1 rows\), foreign_key customer_id -> customers \(1 rows\)"):
        snapshot.load(str(files))
    assert {name: sorted(map(tuple, df.collect()), key=str) for name, df in snapshot.tables().items()} == before
    assert sorted(glob.glob(f"{tmp_path}/store/data/*/*")) == folders  # nothing is left of it
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        (files / "orders.csv").write_text("a,b,c,d\nx,2021-01-01,new,5\n")
        snapshot.load(str(files))
    assert snapshot.state()[0] == 1

    (files / "orders.csv").write_text("a,b,c,d\n2,2021-01-01,new,5\n1,2021-01-01,new,5\n1,2021-01-01,new,5\n")
    snapshot.load(str(files))  # children meet the new parents
    assert counts(snapshot) == {n: len(t.splitlines()) for n, t in FILES.items()}


def test_append_single_tables_and_readers(spark, files, tmp_path):
    snapshot = Snapshot(spark, f"{tmp_path}/store")
    with pytest.raises(ConstraintError, match="foreign_key region_id"):
        snapshot.load(str(files), "suppliers")  # no regions yet
    assert snapshot.tables() == {} and snapshot.load(str(tmp_path)) == [] and snapshot.state()[0] == 0
    snapshot.load(str(files), ["suppliers", "regions"])
    reader = snapshot.tables()["regions"]
    assert [(x.table, x.rows) for x in snapshot.load(str(files), "regions", "append")] == [("regions", 2)]
    assert sorted(r.region_id for r in snapshot.tables()["regions"].collect()) == [1, 2, 3, 4]
    assert reader.count() == 2  # a reader keeps the version it began with
    with pytest.raises(ValueError, match="unknown tables"):
        snapshot.load(str(files), "nothing")
    snapshot.load(str(files), "regions")
    gone = snapshot.expire(1)
    assert len(gone) == 2 and counts(snapshot) == {"regions": 2, "suppliers": 1} and len(glob.glob(f"{tmp_path}/store/data/*/*")) == 2
    snapshot.register("registered")
    assert spark.table("registered.regions").count() == 2 and spark.table("registered.orders").count() == 0


def test_the_second_of_two_loads_fails(spark, files, tmp_path, monkeypatch):
    one, two = (Snapshot(spark, f"{tmp_path}/store") for _ in range(2))
    begun = two.state()
    one.load(str(files), "regions")
    monkeypatch.setattr(two, "state", lambda: begun)
    with pytest.raises(ConflictError):
        two.load(str(files), "regions")
    monkeypatch.undo()
    assert counts(two) == {"regions": 2}


def test_forests_score_after_a_load(spark, files, tmp_path):
    Snapshot(spark, f"{tmp_path}/store").load(str(files), "regions")
    rows = spark.createDataFrame([(float(i), i % 2) for i in range(20)], "x double, y int")
    model = train.fit_random_forest(rows, ["x"], "y", numTrees=1, maxDepth=1)
    assert train.with_probability(model, rows).count() == len(train.with_probability(model, rows).collect()) == 20


def test_rules_are_counted_by_the_write_alone(spark, tmp_path):
    own = loading_session(spark)
    rows = own.createDataFrame(
        [(1, 1, 1, 5, None, None), (2, 1, 1, 0, None, None), (3, 1, 1, None, None, None), (4, 1, 1, -2, None, None)],
        TABLES["order_items"].schema,
    ).repartition(3)
    n, highest, broken = store_observed(rows, TABLES["order_items"], f"{tmp_path}/x")
    assert (n, highest, broken) == (4, 4, {"not_null quantity": 1, "check quantity_positive": 2})
    report = constraints.columns({"order_items": spark.read.parquet(f"{tmp_path}/x")}).filter("violations > 0").collect()
    assert {f"{r.kind} {r.rule}": r.violations for r in report} == broken
    assert store_observed(rows.limit(0), TABLES["order_items"], f"{tmp_path}/y") == (0, 0, {})
