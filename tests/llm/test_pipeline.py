"""The pipeline, each stage against a brute-force version on its own input."""

import collections
import zlib

import corpus_pipeline
from salescope.llm.common import staged, table
from test_operators import SF, WORDS, base_spans, components, encoded, quality, shingles


def repeated(words, size):
    """Words inside runs of ``size`` words found twice or more."""
    runs = [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]
    seen = collections.Counter(runs)
    return {i + j for i, run in enumerate(runs) if seen[run] > 1 for j in range(size)}


def keeps(text):
    words = WORDS.findall(text or "")
    return not quality(text)[-1] and len(repeated(words, 8)) <= 0.4 * len(words) and not repeated(words, 101)


def leaks(text, items):
    have = shingles((text or "").lower(), False)
    known = set(have)
    for item in items:
        if known.isdisjoint(item):
            continue
        for start in range(1 - len(item), len(have)):
            part = have[max(0, start):start + len(item)]
            both = sum((collections.Counter(part) & collections.Counter(item)).values())
            if 100 * both >= 80 * (len(part) + len(item) - both):
                return True
    return False


def redacted(text):
    if text is None:
        return None
    at, out = 0, ""
    for start, _, end, _ in base_spans(text):
        if start >= at:
            out += text[at:start] + "[secret]"
        at = max(at, end)
    return out + text[at:]


def test_stages(spark):
    docs = table(spark, SF, "documents")
    items = [shingles((r["text"] or "").lower(), False) for r in table(spark, SF, "benchmark").collect()]
    want = {
        "quality_rules": lambda rows: [(k, t) for k, t in rows if keeps(t)],
        "ngram_jaccard_join": lambda rows: [(k, t) for k, t in rows if k in {c for _, _, c in components(rows)}],
        "benchmark_decontamination": lambda rows: [(k, t) for k, t in rows if not leaks(t, items)],
        "secret_scans": lambda rows: [(k, redacted(t)) for k, t in rows],
    }
    assert [name for name, _ in corpus_pipeline.STAGES] == [*want, "packing"]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, SF), f"test-{name}")
        assert out.columns == docs.columns
        got = [(r["doc_id"], r["text"]) for r in out.collect()]
        assert collections.Counter(got) == collections.Counter(want[name](rows)), name
        assert all(r["n_chars"] == len(r["text"] or "") for r in out.select("n_chars", "text").collect())
        docs, rows = out, got
    ids = dict(encoded(rows, "word_bpe_49k.json", 2))
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in pieces} == set(ids)
    at = dict.fromkeys(ids, 0)
    for r in sorted(pieces, key=lambda r: (r["doc_id"], r["start"])):
        k = r["doc_id"]
        assert r["start"] == at[k] and r["doc_tokens"] == len(ids[k])
        at[k] += r["length"]
        assert zlib.crc32(ids[k][r["start"]:at[k]].tobytes()) == r["ids_crc32"]
    assert all(at[k] == len(i) for k, i in ids.items())
    full = collections.Counter()
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == full[r["sequence_id"]]
        full[r["sequence_id"]] += r["length"]
    assert all(n == 4096 or n < 4096 and n & (n - 1) == 0 for n in full.values())


def test_stages_on_odd_rows(spark):
    rows = [(1, None), (None, ""), (2, " ".join(f"w{i}" for i in range(60))), (2, " ".join(f"w{i}" for i in range(60))), (3, "a b")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "'x' AS node", "1 AS _hash", "'en' AS lang")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = staged(stage(spark, docs, SF), f"odd-{name}")
            assert out.columns == docs.columns
            docs = out
        assert [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()] == rows[2:3] * bool(data)
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        want = encoded(rows[2:3] * bool(data), "word_bpe_49k.json", 2)
        # the last sequences end at powers of two, so one document can be several pieces
        assert {(r["doc_id"], r["doc_tokens"]) for r in pieces} == {(k, len(i)) for k, i in want}
        assert sum(r["length"] for r in pieces) == sum(len(i) for _, i in want)
