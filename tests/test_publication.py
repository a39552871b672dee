"""Publication by key: states, refusals, and a crash between any two steps."""

import uuid

import pytest
from pyspark.sql import functions as F

from statloom.session import shared_dir
from statloom.sources import publication

DOC = "title string, partial_sample boolean"


@pytest.fixture
def root(spark):
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"


def run(spark, root, docs, discovered=None, failures=(), complete=True):
    documents = spark.createDataFrame([(k, t, p) for k, t, p in docs], f"key string, {DOC}")
    found = spark.createDataFrame([(k,) for k in (discovered if discovered is not None else [d[0] for d in docs])], "key string")
    return publication.publish(spark, root, documents, found, spark.createDataFrame(list(failures), "key string, error string"), {"no title": F.col("title").isNotNull()}, complete)


def state(spark, root):
    documents, held, commit = publication.read(spark, root, DOC)
    return {r["key"]: r["title"] for r in documents.collect()}, {r["key"]: r["status"] for r in held.collect()}, commit and commit["number"]


def test_all_states(spark, root):
    first = run(spark, root, [("one", "a", False), ("two", "b", False), ("three", "c", False)])
    assert first["complete"] and first["discovered_count"] == 3
    second = run(spark, root, [("one", "new", False), ("two", None, False), ("four", "d", True), ("five", "e", None), ("five", "f", None)], failures=[("six", "timeout"), ("one", "late")])
    assert not second["complete"]
    documents, held, _ = publication.read(spark, root, DOC)
    assert {r["key"]: (r["status"], r["error"]) for r in held.collect()} == {
        "one": ("retained", "late"), "two": ("retained", "Validation failed: no title"), "three": ("no_longer_listed", None),
        "four": ("failed", "Validation failed: document reports incomplete coverage: partial_sample"), "five": ("failed", "Validation failed: several documents"), "six": ("failed", "timeout")}
    assert {r["key"]: r["title"] for r in documents.collect()} == {"one": "a", "two": "b", "three": "c"}
    run(spark, root, [("one", "z", False)], discovered=["one"], complete=False)
    titles, states, _ = state(spark, root)
    assert titles["one"] == "z" and states["two"] == states["three"] == "retained" and states["six"] == "failed"


def test_siblings_are_published_and_nothing_found_is_not_success(spark, root):
    run(spark, root, [("one", "old", False)])
    assert not run(spark, root, [("one", None, False), ("two", "new", False)])["complete"]
    assert state(spark, root)[0] == {"one": "old", "two": "new"}
    assert not run(spark, f"{root}-empty", [])["complete"]


@pytest.mark.parametrize("bad", ["../up", "", None, "manifest", "a b"])
def test_unsafe_keys_write_nothing(spark, root, bad):
    with pytest.raises(publication.UnsafeKey):
        run(spark, root, [("good", "a", False)], discovered=["good", bad])
    assert publication.latest(spark, root) is None and not publication._fs(spark, root)[0].exists(publication._fs(spark, root)[1])


@pytest.mark.parametrize("step", ["_write_documents", "_write_records", "_commit"])
@pytest.mark.parametrize("after", [False, True])
def test_crash_between_steps(spark, root, monkeypatch, step, after):
    run(spark, root, [("one", "a", False), ("two", "b", False)])
    before, real = state(spark, root), getattr(publication, step)

    def crash(*args):
        if after:
            real(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(publication, step, crash)
        with pytest.raises(RuntimeError, match="lost"):
            run(spark, root, [("one", "new", False), ("three", "c", False)])
    done = step == "_commit" and after
    titles, states, number = state(spark, root)
    assert (titles, states, number) == (({"one": "new", "two": "b", "three": "c"}, {"one": "fresh", "two": "no_longer_listed", "three": "fresh"}, 2) if done else before)
    run(spark, root, [("one", "last", False), ("two", "b", False)])
    assert state(spark, root)[0]["one"] == "last" and state(spark, root)[2] == number + 1


def test_a_number_is_taken_once(spark, root):
    run(spark, root, [("one", "a", False)])
    with pytest.raises(publication.Conflict):
        publication._commit(spark, root, {"number": 1, "version": "other"})
    assert state(spark, root)[0] == {"one": "a"}


def test_rewrite_keeps_what_readers_see(spark, root):
    for title in "abc":
        run(spark, root, [("one", title, False), (f"only-{title}", title, False)], complete=False)
    before = state(spark, root)
    publication.rewrite(spark, root, DOC)
    assert state(spark, root)[:2] == before[:2]
    fs, where = publication._fs(spark, f"{root}/documents")
    assert len(fs.listStatus(where)) == 1
    assert publication.rewrite(spark, f"{root}-none", DOC) is None
