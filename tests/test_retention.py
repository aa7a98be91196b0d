"""Replaced files go; what is published, waits to be published, or was journaled stays."""

from pathlib import Path

import pytest

from tests.conftest import at
from tierline.sources.store import TableStore


def folders(root):
    return {str(p.relative_to(root)) for p in Path(root).rglob("*=*") if p.is_dir()}


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "w")


def test_only_replaced_folders_go(spark, root):
    store = TableStore(spark, root, buckets=4, new=True)

    def rows(lo, hi, value):
        return spark.range(lo, hi).selectExpr("id", f"'{value}' as note")

    def merged(table, lo, hi, value):
        """Rows of a range replaced: the buckets they touch written anew."""
        batch = rows(lo, hi, value)
        touched = store.touched(table, batch, ["id"])
        kept = store.read(table, buckets=touched).join(batch.select("id"), "id", "left_anti")
        return store.write(table, store.shuffled(kept.unionByName(batch), ["id"]), ["id"], touched=touched)

    def content(s):
        return {t: sorted(map(tuple, s.read(t).collect())) for t in ("ods.a", "dds.plain", "dm.x")}

    store.publish(store.write("ods.a", store.shuffled(rows(0, 40, "1"), ["id"]), ["id"]))
    for n in (2, 3, 4):
        store.publish(merged("ods.a", n, n + 1, str(n)))
    for n in (1, 2, 3):
        store.publish(store.write("dds.plain", rows(0, n, str(n))))
    store.publish(store.write("dm.x", store.shuffled(rows(0, 9, "old"), ["id"]), ["id"]))
    store.forget("dm.x")
    store.publish(store.write("dm.x", store.shuffled(rows(0, 5, "new"), ["id"]), ["id"]))
    store.publish(store.write("dm.y", rows(0, 3, "gone")))
    store.forget("dm.y")
    store.publish(store.mark("seen.a", 3))
    for batch in (1, 2):
        store.publish(store.write_batch("a", rows(0, batch, "j"), batch))
    store.log_event(2, "raw.load_a", "SUCCESS", at("2024-01-01"))
    store.staged("batch.a", rows(0, 3, "s"))
    half = [store.write("dds.plain", rows(0, 7, "half")), merged("ods.a", 0, 2, "half")]  # written, not yet published
    before = content(store)

    removed = store.remove_replaced()
    left = folders(root)
    assert removed > 0 and content(store) == before
    assert {"dds/plain/v=1", "dds/plain/v=2", "dm/x/v=1", "dm/y/v=1"}.isdisjoint(left) and {"dds/plain/v=3", "dds/plain/v=4", "dm/x/v=2"} <= left
    assert not Path(root, "_staged").exists() and {"journal/a/batch_id=1", "journal/a/batch_id=2"} <= left
    holders = {}
    for folder in left:
        if folder.startswith("ods/a/") and "_bucket=" in folder and "v=5" not in folder:
            holders.setdefault(folder.split("_bucket=")[1], []).append(folder)
    assert sorted(holders) == ["0", "1", "2", "3"] and all(len(x) == 1 for x in holders.values())
    assert store.remove_replaced() == 0

    assert content(TableStore(spark, root, buckets=4)) == before
    store.publish(*half)
    after = content(store)
    assert after["dds.plain"] == [(k, "half") for k in range(7)]
    assert after["ods.a"] == sorted({**dict(before["ods.a"]), 0: "half", 1: "half"}.items())
    again = TableStore(spark, root, buckets=4)
    again.remove_replaced()
    assert content(again) == after and "dds/plain/v=3" not in folders(root)
    assert sorted(r["batch_id"] for r in again.read_journal("a").collect()) == [1, 2, 2]
