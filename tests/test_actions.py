"""File actions by plan and journal: exchanges of names, conflicts, crashes at any point."""

import pytest

from tessera.sources import actions, sinks

SCHEMA = "action string, source string, target string"


def tree(root):
    return {str(p.relative_to(root)): p.read_text() for p in sorted(root.rglob("*")) if p.is_file() and not p.name.endswith(".crc")}


@pytest.fixture
def files(tmp_path):
    root = tmp_path / "tree"
    for name in ("a", "b", "c", "d", "keep", "gone", "x/1", "x/2"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(f"was {name}")
    return root


def rows(spark, root, *acts):
    return spark.createDataFrame([(a, str(root / s), str(root / t) if t else None) for a, s, t in acts], SCHEMA)


ACTS = [
    ("rename", "a", "b"), ("rename", "b", "c"), ("rename", "c", "a"),  # a ring
    ("rename", "d", "keep"),  # there is a file that stays
    ("rename", "x/1", "new/1"), ("rename", "x/2", "new/1"),  # one name for two
    ("copy", "keep", "copies/keep"), ("copy", "keep", "copies/keep2"), ("delete", "gone", None), ("delete", "never", None), ("rename", "nothing", "n"),
    ("rename", "keep", "keep"), ("chmod", "keep", "k"), ("rename", "x/1", "other"),
]

AFTER = {"a": "was c", "b": "was a", "c": "was b", "d": "was d", "keep": "was keep", "new/1": "was x/1", "x/2": "was x/2", "copies/keep": "was keep", "copies/keep2": "was keep"}


def statuses(df, root):
    return {(r.action, r.source.removeprefix(f"{root}/"), (r.target or "").removeprefix(f"{root}/")): r.status for r in df.collect()}


def check(got):
    assert got["rename", "a", "b"] == got["rename", "b", "c"] == got["rename", "c", "a"] == got["copy", "keep", "copies/keep2"] == got["delete", "never", ""] == "done"
    assert got["rename", "d", "keep"] == "conflict: exists" and got["rename", "x/2", "new/1"] == "conflict: target taken"
    assert got["rename", "nothing", "n"] == "missing" and got["rename", "keep", "keep"] == "unchanged" and got["chmod", "keep", "k"] == "unknown action"
    assert sorted([got["rename", "x/1", "new/1"], got["rename", "x/1", "other"]]) == ["conflict: source taken", "done"]


def test_actions_and_rerun(spark, files, tmp_path):
    journal = str(tmp_path / "journal")
    got = statuses(actions.carried_out(rows(spark, files, *ACTS), journal), files)
    check(got)
    assert tree(files) == AFTER
    # again, with a plan that now would say something else: the journal's counts, and all of it is done
    assert statuses(actions.carried_out(rows(spark, files, ("delete", "a", None)), journal), files) == got
    assert tree(files) == AFTER


@pytest.mark.parametrize("step", range(0, 14, 3))
def test_actions_after_a_crash(spark, files, tmp_path, monkeypatch, step):
    """The first run stops after so many moves, copies and deletions; the second goes on."""
    journal, whole = str(tmp_path / "journal"), actions._each

    def until(df, act):
        done = {"n": 0}
        path = str(tmp_path / "count")

        def stopping(fs, r, source, target, aside):
            import os
            import pathlib

            pathlib.Path(path).mkdir(exist_ok=True)
            if len(os.listdir(path)) >= step:
                raise RuntimeError("killed here")
            out = act(fs, r, source, target, aside)
            (pathlib.Path(path) / f"{len(os.listdir(path))}-{done['n']}-{r.id}-{out}").touch()
            return out

        return whole(df, stopping)

    monkeypatch.setattr(actions, "_each", until)
    with pytest.raises(Exception, match="killed here"):
        actions.carried_out(rows(spark, files, *ACTS), journal)
    monkeypatch.setattr(actions, "_each", whole)
    got = statuses(actions.carried_out(rows(spark, files, *ACTS), journal), files)
    check(got)
    assert tree(files) == AFTER


def test_copies_over_existing_files(spark, files, tmp_path):
    one = rows(spark, files, ("copy", "a", "keep"), ("copy", "b", "c"))
    (files / "keep").write_text("xxx a")  # as long as a, but another text
    (files / "c").write_text("longer than it was")
    assert set(statuses(actions.carried_out(one, str(tmp_path / "j1")), files).values()) == {"conflict: exists"}
    assert set(statuses(actions.carried_out(one, str(tmp_path / "j2"), overwrite=True), files).values()) == {"done"}
    assert tree(files)["keep"] == "was a" and tree(files)["c"] == "was b"
    assert actions.carried_out(one.limit(0), str(tmp_path / "j3")).count() == 0


def test_clean_copies_of_point_files(spark, tmp_path):
    from tessera.operators.quality import clean_points

    df = spark.createDataFrame([("p1.csv", k, float(k), 0.0, 0.0 if k else 0.0, 0.0) for k in range(4)] + [("p2.csv", 0, 1.0, float("nan"), 1.0, 1.0), ("p2.csv", 1, 1.5, 2.5, 3.5, 4.5)], "file string, n int, x double, y double, z double, intensity double")
    done = sinks.csv_files(clean_points(df, ["x", "y", "z", "intensity"]).drop("m"), str(tmp_path / "clean"), "file", ["n"])
    assert {(r["__file"], r["n"]) for r in done.collect()} == {("p1.csv", 3), ("p2.csv", 1)}
    assert (tmp_path / "clean" / "p2.csv").read_text() == "n,x,y,z,intensity\n1,1.5,2.5,3.5,4.5\n"
