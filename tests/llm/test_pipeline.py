"""Each stage against brute force on what the stage before it kept."""

import re

import corpus_pipeline
import pytest
from test_line_dedup import brute as brute_lines
from test_packing import check as check_packing

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Rows before the first and after every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, tables = docs.columns, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp("stage") / name)
        result = stage(spark, docs, SF)
        if name != "packing":
            assert result.columns == columns
        result.write.parquet(folder)
        docs = spark.read.parquet(folder)
        tables.append(docs.collect())
    return tables


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_quality_keeps_good_documents(spark, kept):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = texts(kept[0]), texts(kept[1])
    assert set(after.items()) <= set(before.items())
    good = [i for i in before if labels.get(i) == 1]
    bad = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in good) >= 0.9 * len(good)
    assert sum(i in after for i in bad) <= 0.4 * len(bad)


def test_line_dedup(kept):
    expected = brute_lines([(r.doc_id, r.text) for r in kept[1]])
    old = texts(kept[1])
    assert texts(kept[2]) == {i: t for i, t in expected.items() if t == old[i] or t.split()}
    assert all(r.n_chars == len(r.text) for r in kept[2])


def shingles(text):
    words = text.translate(LOWER).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_one_of_each_group(kept):
    sets = {r.doc_id: shingles(r.text) for r in kept[2]}
    smallest = {i: i for i in sets}
    changed = True
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(smallest[a], smallest[b])
            changed |= smallest[a] != low or smallest[b] != low
            smallest[a] = smallest[b] = low
    assert {r.doc_id for r in kept[3]} == {i for i in sets if smallest[i] == i or not sets[i]}


def test_decontamination(spark, kept):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = word.findall((r.text or "").translate(LOWER))
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    lengths = {len(w) for w in windows}
    clean = set()
    for r in kept[3]:
        w = word.findall(r.text.translate(LOWER))
        hit = {p for n in lengths for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for p in range(i, i + n)}
        if not (hit and 20 * len(hit) >= len(w)):
            clean.add(r.doc_id)
    assert {r.doc_id for r in kept[4]} == clean


def test_packing(kept):
    check_packing(kept[5], texts(kept[4]))


def test_run_gives_the_same_documents(spark, kept):
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()} == set(texts(kept[4]))


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF)
        assert result.count() == 0


def _shortened(monkeypatch, fails=False):
    """Stages that only count themselves."""
    done = []

    def stage(name):
        def step(spark, docs, sf_dir):
            if fails and name == "packing":
                raise RuntimeError("stopped")
            done.append(name)
            return docs.where("doc_id % 2 = 0")

        return step

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, stage(name)) for name, _ in corpus_pipeline.STAGES])
    return done


def test_a_run_goes_on_behind_its_last_finished_stage(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "stages")
    done = _shortened(monkeypatch, fails=True)
    with pytest.raises(RuntimeError):
        corpus_pipeline.run(spark, SF, folder)
    assert done == ["quality", "line_dedup", "near_duplicates", "decontamination"]
    done = _shortened(monkeypatch)
    assert corpus_pipeline.run(spark, SF, folder).count() > 0 and done == ["packing"]
    assert sorted(p.name for p in (tmp_path / "stages").iterdir()) == sorted(name for name, _ in corpus_pipeline.STAGES)


def test_files_of_inner_stages_go(spark, monkeypatch):
    from pathlib import Path

    corpus_pipeline.use_checkpoint_folder(spark)
    shared = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(shared.glob("pipeline-*"))
    _shortened(monkeypatch)
    rows = corpus_pipeline.run(spark, SF)
    (own,) = set(shared.glob("pipeline-*")) - before
    assert [p.name for p in own.iterdir()] == ["packing"] and rows.count() > 0
    _shortened(monkeypatch, fails=True)
    with pytest.raises(RuntimeError):
        corpus_pipeline.run(spark, SF)
    assert set(shared.glob("pipeline-*")) - before == {own}
