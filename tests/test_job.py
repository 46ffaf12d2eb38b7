"""Files in, files out."""

import json

import pytest
from conftest import as_dict
from data import ratings

from starwise.config import Config, LshConfig, ModelConfig
from starwise.plans.job import JobPaths, count_left_out, evaluate_files, run_job
from starwise.runtime import ensure_checkpoint_dir
from pyspark.sql import Observation

from starwise.sources import profiles
from starwise.sources.ratings import (
    count_unreadable,
    dedupe_last,
    read_placed,
    read_predictions,
    read_ratings,
    read_requests,
    with_positions,
    write_predictions,
)


def test_readers(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("user_id,business_id,stars\nu1,b1,4.0\nu2,b2\nu3,b3,2.5,extra\nu4,b4,x\n")
    assert {tuple(r) for r in read_ratings(spark, str(path)).collect()} == {("u1", "b1", 4.0), ("u3", "b3", 2.5)}
    assert read_ratings(spark, str(path)).count() == 2
    assert read_requests(spark, str(path)).count() == 4
    assert count_unreadable(spark, str(path)) == 2
    path.write_text("user_id,business_id\nu1,b1\nu2,b2\n")
    assert {tuple(r) for r in read_requests(spark, str(path)).collect()} == {("u1", "b1"), ("u2", "b2")}


def test_left_out_lines_are_counted_while_they_are_read(spark, tmp_path):
    (tmp_path / "r.csv").write_text("user_id,business_id,stars\nu1,b1,4.0\nu2,b2\nu4,b4,x\n")
    (tmp_path / "u.json").write_text('{"user_id": "a"}\n[1]\nnonsense\n\n{"user_id": 2}\n')
    seen, lines = Observation("r"), Observation("u")
    assert read_ratings(spark, str(tmp_path / "r.csv"), seen).count() == 1
    assert seen.get == {"lines": 3, "left_out": 2}
    assert profiles.user_features(profiles.observed(profiles.read_json_lines(spark, str(tmp_path / "u.json")), lines)).count() == 2
    assert lines.get == {"lines": 4, "left_out": 2}


def test_the_last_line_wins_and_lines_have_positions(spark, tmp_path):
    names = ["part-0.csv", "part-1.csv", "part-2.csv"]
    lines = [[(f"u{(7 * k + n) % 50}", f"b{k % 3}", float(1 + (k + n) % 5)) for k in range(400)] for n in range(3)]
    for name, rows in zip(names, lines):
        (tmp_path / name).write_text("user,item,stars\n" + "".join(f"{u},{i},{s}\n" for u, i, s in rows))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")  # several blocks per file
    try:
        placed = read_placed(spark, str(tmp_path))
        assert placed.select("place.block").distinct().count() > 2
        flat = [row for rows in lines for row in rows]
        assert {(r.user, r.item): r.stars for r in dedupe_last(placed).collect()} == {(u, i): s for u, i, s in flat}
        found = with_positions(placed).orderBy("position").collect()
        assert [r.position for r in found] == list(range(len(flat)))
        assert [(r.user, r.item, r.stars) for r in found] == flat
        assert with_positions(placed.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_the_last_line_is_found_without_a_sort_and_by_odd_file_names(spark, tmp_path):
    """Later files win by name, whatever their names hold and in whatever order they are read."""
    folder = tmp_path / "a b%20c"
    folder.mkdir()
    lines = {"x 2.csv": ("u,i,1", "u,j,2"), "x%202.csv": ("u,i,3", "v,i,5", "u,i,4"), "a\u00e9.csv": ("u,j,5", "v,i,1")}
    for name, rows in lines.items():
        (folder / name).write_text("\n".join(("user,item,stars", *rows)) + "\n")
    placed = read_placed(spark, str(folder))
    found = dedupe_last(placed)
    assert {(r.user, r.item): r.stars for r in found.collect()} == {("u", "i"): 4.0, ("u", "j"): 2.0, ("v", "i"): 5.0}
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_every_request_is_read(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text("user_id,business_id\nu1,b1\nu2,\n,b3\nu4\n")
    found = read_requests(spark, str(path), "at").orderBy("at").collect()
    assert [(r.user, r.item) for r in found] == [("u1", "b1"), ("u2", ""), ("", "b3"), ("u4", "")]


def test_predictions_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("u", "b", 3.25), ("v", "b", 1.0)], "user string, item string, prediction double")
    out = str(tmp_path / "out")
    write_predictions(df.repartition(2), out)
    assert {tuple(r) for r in read_predictions(spark, out).collect()} == {("u", "b", 3.25), ("v", "b", 1.0)}
    first = next((tmp_path / "out").glob("part-*.csv")).read_text().splitlines()[0]
    assert first == "user_id,business_id,prediction"


def test_checkpoint_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    found = ensure_checkpoint_dir(spark)
    assert found and (named is None or named.rstrip("/") in found)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("job")
    (root / "data").mkdir()
    rows = ratings(users=60, items=30, prefix="x")
    held = rows[::9]
    train = [r for k, r in enumerate(rows) if k % 9]
    head = "user_id,business_id,stars\n"
    to_csv = lambda data: head + "".join(f"{u},{i},{s}\n" for u, i, s in data)
    (root / "data" / "some_train.csv").write_text(to_csv(train))
    (root / "data" / "val.csv").write_text(to_csv(held + [held[0], ("new", "x1", 3.0), ("x1", "new", 3.0), ("x1", "", 3.0), ("", "x1", 3.0)]))
    users = [{"user_id": f"x{k}", "average_stars": 3.0, "review_count": k} for k in range(60)]
    items = [{"business_id": f"x{k}", "stars": 2.0 + k % 3, "attributes": {}} for k in range(30)]
    (root / "data" / "user.json").write_text("\n".join(map(json.dumps, users)) + "\n\n")
    (root / "data" / "business.json").write_text("\n".join(map(json.dumps, items)) + "\n")
    return root, held


def test_job(spark, folder):
    root, held = folder
    config = Config(
        lsh=LshConfig(bands=20, rows=1, min_item_ratings=5),
        model=ModelConfig(n_estimators=5, learning_rate=0.3),
        gate_neighbors=5,
    )
    left_out = {}
    written = run_job(spark, JobPaths(str(root), "val.csv", "predictions", "some_train.csv"), config, left_out)
    assert left_out == {"ratings": 0, "users": 0, "items": 0}
    assert written.count() == len(held) + 5
    asked = [*held, held[0], ("new", "x1"), ("x1", "new"), ("x1", ""), ("", "x1")]
    assert [(r.user, r.item) for r in written.collect()] == [tuple(r[:2]) for r in asked]
    assert all(1 <= r.prediction <= 5 for r in written.collect())
    found = as_dict(written.distinct(), "user", "item")
    assert found.keys() == {(u, i) for u, i, _ in held} | {("new", "x1"), ("x1", "new"), ("x1", ""), ("", "x1")}
    assert count_left_out(spark, JobPaths(str(root), "val.csv", "predictions", "some_train.csv")) == {"ratings": 0, "users": 0, "items": 0}
    score = evaluate_files(spark, str(root / "data" / "val.csv"), str(root / "output" / "predictions")).first()
    assert score.n == len(held) + 2 and 0 < score.rmse < 2
