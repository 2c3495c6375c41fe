"""The pipeline's stages against plain Python on a small fixture."""

import struct
import zlib
from collections import Counter

import helpers as h

import corpus_pipeline
from altiplano.llm import queries

BENCH = [(1, "alpha beta gamma delta sun moon river stone the of and to in"), (2, None)]


def runs_removed(docs):
    """Line dedup: lines with a word that lie in two consecutive lines seen before."""
    seen, out = set(), {}
    for i in sorted(docs):
        lines = docs[i].split("\n")
        at = [j for j, x in enumerate(lines) if h.words(x)]
        gone = set()
        for a, b in zip(at, at[1:]):
            if (lines[a], lines[b]) in seen:
                gone |= {a, b}
            seen.add((lines[a], lines[b]))
        rest = "\n".join(x for j, x in enumerate(lines) if j not in gone)
        if not gone or h.words(rest):
            out[i] = rest
    return out


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def near_removed(docs):
    sets = {}
    for i, t in docs.items():
        w = h.words(lower(t))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i in docs}
    changed = True
    while changed:
        changed = False
        for i in docs:
            for j in docs:
                if sets[i] and sets[j] and up[i] != up[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    up[i] = up[j] = min(up[i], up[j])
                    changed = True
    return {i: t for i, t in docs.items() if up[i] == i}


def test_stages_take_effect(spark, tmp_path):
    rows = h.documents(11, 50)
    rows += [(900, "lead words here " + BENCH[0][1] + " tail " + " ".join(f"u{i}" for i in range(40)), "en", "s", 1), (901, "x " * 100, "en", "s", 1)]
    at = h.write(spark, tmp_path, rows, benchmark=(BENCH, "item_id long, text string"))
    docs = spark.read.parquet(f"{at}/documents.parquet")
    want = {}
    for i, t, *_ in rows:
        w = h.words(t)
        windows = [tuple(w[j : j + 8]) for j in range(len(w) - 7)]
        twice = Counter(windows)
        hit = {j + o for j, x in enumerate(windows) if twice[x] > 1 for o in range(8)}
        if len(w) >= 20 and 100 * len(hit) <= 30 * len(w):
            want[i] = t
    steps = [want, runs_removed(want)]
    steps.append(near_removed(steps[-1]))
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:3], steps, strict=False):
        docs = stage(spark, docs, at)
        assert docs.columns == h.COLUMNS, name
        got = {r.doc_id: r.text for r in docs.collect()}
        assert got == expected, name
        docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in got.items()], h.SCHEMA)
    docs = corpus_pipeline.STAGES[3][1](spark, docs, at)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert "gamma delta sun moon" not in texts[900] and texts[900].startswith("lead words here")
    out = corpus_pipeline.run(spark, at).collect()
    assert {r.doc_id for r in out} == set(texts)
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(queries.model_file("word_bpe_49k.json"))
    for r in out:
        part = [*model.encode(texts[r.doc_id], add_special_tokens=False).ids, 1][r.start : r.start + r.length]
        assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r.ids_crc32
