import pytest

from branchwise.llm import sharding
from branchwise.llm.sharding import ShardStore


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_odd_rows(spark, odd_docs):
    clash = odd_docs.selectExpr("*", "'x' AS _arrival", "'x' AS tier")
    got = sharding.shard(clash, arrivals=5, target_bytes=1 << 16, base_bytes=1 << 10, fanout=2)
    assert rows(got.select(*[c for c in clash.columns if c not in ("shard", "tier", "version")])) == rows(clash.drop("shard", "tier", "version"))
    assert got.where("shard IS NULL OR tier IS NULL OR version IS NULL").count() == 0
    empty = sharding.shard(clash.limit(0))
    assert empty.count() == 0 and set(clash.columns) <= set(empty.columns)


@pytest.fixture()
def store(spark, tmp_path):
    return ShardStore(spark, f"file://{tmp_path}/s", target_bytes=1 << 20, base_bytes=1 << 12, fanout=3, keep_versions=4)


def test_tiers_and_versions(spark, store, tmp_path):
    for k in range(9):
        store.append(spark.range(k * 100, k * 100 + 100))
        assert store.read().count() == 100 * k + 100
        sizes = [r["tier"] for r in store.manifest()["runs"]]
        assert max(sizes.count(t) for t in sizes) < 3
    versions = store.versions()
    assert len(versions) == 4 and versions[-1] == store.version()
    assert [store.read(v).count() for v in versions][-1] == 900 and all(store.read(v).count() % 100 == 0 for v in versions)
    named = {r["name"] for v in versions for r in store.manifest(v)["runs"]}
    assert {p.name for p in (tmp_path / "s/runs").iterdir() if not p.name.startswith(".")} == named


def test_crash_between_move_and_commit(spark, store, monkeypatch):
    store.append(spark.range(10))
    with monkeypatch.context() as m:
        m.setattr(ShardStore, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            store.append(spark.range(10, 20))
    store.append(spark.range(20, 30))
    assert store.read().columns == ["id"] and sorted(r.id for r in store.read().collect()) == [*range(10), *range(20, 30)]
    assert len(store.vacuum()) == 1 and store.vacuum() == [] and store.read().count() == 20


def test_two_writers(spark, store, tmp_path, monkeypatch):
    """Another writer commits first, again and again: nothing is lost and nothing overwritten."""
    other = ShardStore(spark, store.root, 1 << 20, 1 << 12, 3, 4)
    real, left = ShardStore._publish, [3]

    def publish(self, manifest):
        if self is store and left[0]:
            left[0] -= 1
            other.append(spark.range(1000 * left[0], 1000 * left[0] + 5))
        return real(self, manifest)

    monkeypatch.setattr(ShardStore, "_publish", publish)
    store.append(spark.range(50_000, 50_010))
    assert store.read().count() == 25 and other.version() == store.version()


def test_whole_table_against_its_input(spark):
    import hashlib
    from collections import Counter

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = sharding.op8_sharding(spark, "/root/testdata/sf0.01").collect()
    want = Counter((r.doc_id, None if r.text is None else len(r.text), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs)
    assert Counter((r.doc_id, r.n_chars, r.text_sha256) for r in got) == want
    [version] = {r.version for r in got}
    tiers = {}
    for r in got:
        tiers.setdefault(r.tier, set()).add(r.shard.split("/")[0])
    assert version > 16 and all(len(runs) < 4 for runs in tiers.values())  # a tier never holds as many runs as are merged
