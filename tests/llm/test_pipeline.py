"""The pipeline and the registered queries, run over the smallest tables."""

import collections

import corpus_pipeline
import pytest
from tests.llm.fixtures import docs, prose
from tests.oracle import compare, duck
from tidemark.llm import decontam, linededup, mixing, neardup, registry, toxicity
from tidemark.llm.common import materialise, table

ORACLES = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_duckdb(spark, sf_small, name):
    problems, rows = compare(registry.queries()[name](spark, sf_small), duck(sf_small), ORACLES[name])
    assert not problems and rows


def test_names_and_contract_columns():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries() if n != "pipeline") == list(range(1, 11))


def test_every_stage_takes_effect(spark, sf_small):
    d = table(spark, sf_small, "documents")
    names = d.columns
    labels, bench = table(spark, sf_small, "labels"), table(spark, sf_small, "benchmark")
    for stage, f in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in d.collect()}
        out = materialise(f(spark, d, sf_small), "test-stage")
        after = out.collect()
        assert set(names) <= set(out.columns)
        if stage == "toxicity":
            bad = {r.doc_id for r in toxicity.classify(d, labels).where("predicted = 1").collect()}
            assert bad and {r.doc_id for r in after} == set(before) - bad
        elif stage == "line_dedup":
            lines = collections.Counter(x for r in after for x in linededup.word_lines(r.text.encode()))
            assert max(lines.values()) == 1 and all(r.n_chars == len(r.text) for r in after)
        elif stage == "near_dedup":
            kept = {r.doc_id for r in neardup.near_duplicates(d).where("kept").collect()}
            assert {r.doc_id for r in after} == kept and len(after) == len(kept)
        elif stage == "decontaminate":
            bad = {r.doc["doc_id"] for r in decontam.contamination(d, bench).where("contaminated").collect()}
            assert bad and {r.doc_id for r in after} == set(before) - bad
        else:
            copies = {r.doc_id: r.copies for r in mixing.mix(d).collect()}
            assert collections.Counter(r.doc_id for r in after) == collections.Counter({k: v for k, v in copies.items() if v})
        d = out
    assert corpus_pipeline.run(spark, sf_small).count() == d.count()


def test_stages_on_an_empty_table(spark, sf_small):
    d = table(spark, sf_small, "documents").limit(0)
    for _, f in corpus_pipeline.STAGES:
        d = materialise(f(spark, d, sf_small), "test-empty")
        assert d.count() == 0


def test_planted_near_copies_do_not_get_through(spark):
    """Through line dedup and near dedup: copies with a changed word in most lines, and with whole lines rewritten."""
    rows, copies = [], set()
    for i in range(10):
        base = [prose(500 + 100 * i + k, 22).replace("\n", " ") for k in range(12)]
        rows.append((i, "\n".join(base), "en", "a", 0))
        words = [x.split(" ") for x in base]
        for k, w in enumerate(words):
            if k % 4:
                w[(3 * k + i) % 22] = f"changed{k}"
        rows.append((100 + i, "\n".join(" ".join(w) for w in words), "en", "a", 0))
        copies.add(100 + i)
        flat = " ".join(base).split(" ")
        for at in (15, 80, 150, 220):
            flat[at] = f"edit{at}"
        rows.append((200 + i, " ".join(flat), "en", "a", 0))  # one long line: only whole documents can be compared
        rows.append((300 + i, " ".join(base), "en", "a", 0))
    d = docs(spark, rows)
    for name, stage in corpus_pipeline.STAGES[1:3]:
        d = materialise(stage(spark, d, ""), f"test-planted-{name}")
    kept = {r.doc_id for r in d.collect()}
    assert not kept & copies and set(range(10)) <= kept
    assert not any(200 + i in kept and 300 + i in kept for i in range(10))
