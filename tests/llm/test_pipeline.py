"""The pipeline, stage by stage, against what the stages promise."""

import re

import corpus_pipeline
from fieldloom.llm.common import table

from . import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark, monkeypatch):
    seen, stages = [], []
    for name, stage in corpus_pipeline.STAGES:
        def watched(spark, docs, sf, stage=stage, name=name):
            out = stage(spark, docs, sf)
            seen.append((name, [r.asDict() for r in docs.collect()], out.columns))
            return out
        stages.append((name, watched))
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    out = [r.asDict() for r in corpus_pipeline.run(spark, SF).collect()]
    columns = table(spark, SF, "documents").columns
    assert [c for _, _, c in seen] == [columns] * 4 + [[*columns, "copy"]]
    (_, start, _), (_, ruled, _), (_, single, _), (_, clean, _), (_, redacted, _) = seen
    # rules: what fails the fixed rules goes; at this size no cutoff can be certified
    assert {r["doc_id"] for r in ruled} == {r["doc_id"] for r in start if not brute.quality(r["text"])[-1]}
    # near copies: the smallest id of every group
    prints = {r["doc_id"]: brute.simhash(r["text"]) for r in ruled}
    root = brute.groups(list(prints.values()))
    first = {}
    for i, p in sorted(prints.items()):
        first.setdefault(root[p], i)
    assert sorted(r["doc_id"] for r in single) == sorted(first.values())
    # leaks: no item left whole, nothing else gone
    items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in table(spark, SF, "benchmark").collect()]
    leaks = {r["doc_id"] for r in single if any(i in " ".join(re.findall(r"\w+", r["text"].lower())) for i in items)}
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in single} - leaks and leaks
    # personal data: same rows, no span left
    assert sorted(r["doc_id"] for r in redacted) == sorted(r["doc_id"] for r in clean)
    assert any(brute.spans(r["text"], brute.PII, brute.keep_pii) for r in clean)
    assert not any(brute.spans(r["text"], brute.PII, brute.keep_pii) for r in redacted)
    # mixture: known texts, numbered copies
    texts = {r["doc_id"]: r["text"] for r in redacted}
    assert all(r["text"] == texts[r["doc_id"]] and r["copy"] in (1, 2) for r in out)
    assert len({(r["doc_id"], r["copy"]) for r in out}) == len(out)


def test_empty_table(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clashing_columns_pass_through(spark, tmp_path):
    """Names the stages use inside: same rows, and the caller's columns stay as they were."""
    extra = ["copy", "__key", "__id", "__row", "row", "row_key", "text_key", "fp", "component", "seed", "copies", "kept"]
    docs = table(spark, SF, "documents")
    wide = docs.selectExpr("*", *[f"concat('{c}', doc_id) AS `{c}`" for c in extra])
    wide.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        table(spark, SF, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == [*wide.columns, "copy_"]
    rows = got.collect()
    assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in extra)
    want = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.text, r.copy_) for r in rows) == sorted((r.doc_id, r.text, r.copy) for r in want)
