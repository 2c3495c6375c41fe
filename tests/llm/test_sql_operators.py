"""Operators that SQL can express, against DuckDB on a fixture with the awkward cases."""

import helpers as h
import pytest
from pyspark.sql import functions as F

from altiplano.llm import common, decontam, jaccard, line_dedup, quality, queries, substring, url_filter

BENCH = [(1, "alpha beta gamma delta sun moon river stone the of and to in"), (2, "Zebra yak"), (3, ""), (4, None), (10, "one"), (5, "alpha beta gamma delta sun moon river stone the of and to in")]
PAGES = [
    (1, "https://www.A.example.com/en/1.html", "x"), (2, "http://a.example.com/en/1?utm_source=feed", "x"), (3, None, "x"), (4, "no scheme", None),
    (5, "https://x.net/", ""), (6, "https://net/en", ""), (7, "https://x.net", ""), (8, "http://b.example.net/en/7?x=1#top", ""), (9, "http://b.example.net/de/7", ""),
    (10, "ftp://q.example.com/de/", ""), (11, "http://org/fr/x", ""), (12, "http://fororg/fr/x", ""), (13, "http://a.example.com/en/1/?utm_source=feed&ref=z", ""), (13, "http://a.example.com/en/1/#q", ""), (None, "http://a.example.com/en/1", ""),
    (14, "http://EXAMPLE.com?b=1&utm_source=x://y", ""), (15, "a://b://c/d?e", ""),
]


@pytest.fixture(scope="module", params=[1, 2])
def at(request, spark, tmp_path_factory):
    rows = h.documents(request.param)
    return h.write(spark, tmp_path_factory.mktemp("sql"), rows, benchmark=(BENCH, "item_id long, text string"), pages=(PAGES, "page_id long, url string, html string"))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, at, name):
    tables = ("documents", "benchmark", "pages")
    h.same(queries.QUERIES[name](spark, at), *h.duck(at, queries.SQL[name], tables))


@pytest.mark.parametrize("name", sorted(set(queries.SQL) - {"op10_url_filters"}))
def test_empty_table(spark, tmp_path, name):
    spark.createDataFrame([], h.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)] * 3 + [(1, None, None, None, None), (1, "a b", None, None, 3), (2, "", None, None, None)]])
def test_all_queries_and_the_pipeline_on_nothing(spark, tmp_path, rows):
    import corpus_pipeline

    at = h.write(spark, tmp_path, rows, benchmark=([(None, None), (1, None)] if rows else [], "item_id long, text string"), pages=([(None, None, None)] if rows else [], "page_id long, url string, html string"))
    for name, f in queries.QUERIES.items():
        n = f(spark, at).count()
        assert n == {"op10_url_filters": min(1, len(rows)), "op7_secret_scan": len(rows)}.get(name, len(rows)), name
    assert corpus_pipeline.run(spark, at).count() == 0


def test_frequent_lines_reject_and_are_removed(spark):
    rows = [(i, "home about contact\nbody " + " ".join(chr(97 + i % 26) + chr(97 + i // 26) + chr(97 + j) for j in range(26)), "en", "a", 0) for i in range(30)]
    rows += [(100 + i, f"home ABOUT contact\n{'Home  about contact' + chr(10)}" * 6 + f"tail{i}", "en", "a", 0) for i in range(3)]
    out = h.pandas(quality.judge(h.clash(h.frame(spark, rows)), with_text=True)).set_index("doc_id").sort_index()
    assert out.kept.loc[:29].all() and not out.kept.loc[100:].any()
    assert out.text[5] == rows[5][1].split("\n")[1] and out.k[5] == "own k"
    assert (out.n_frequent_words.loc[:29] == 3).all()
    one = h.pandas(quality.judge(h.frame(spark, [(1, "alike line\n" + rows[0][1], "en", "a", 0)] * 40)))
    assert (one.n_frequent_words == 0).all()  # copies of one text are one document


def test_line_dedup_passes_other_columns_and_odd_ids(spark):
    rows = [(1, "a\nb\nc", "en", "s", 1), (2, "x\na\nb\ny", "en", "s", 1), (None, "a\nb", "en", "s", 1), (3, "a\n \nb\nz", "en", "s", 1), (2, "x\na\nb\ny", "en", "s", 1)]
    out = line_dedup.dedup_lines(h.clash(h.frame(spark, rows)))
    got = sorted((r.doc_id or 0, r.text, r.n_removed, r.k) for r in out.collect())
    assert got == [(0, "a\nb", 0, "own k"), (1, "a\nb\nc", 0, "own k"), (2, "x\ny", 2, "own k"), (2, "x\ny", 2, "own k"), (3, " \nz", 2, "own k")]
    deep = [(i, "\n".join(f"line {j}" for j in range(37)), "en", "s", 1) for i in range(3)]
    for least in (1, 3, 4):
        out = h.pandas(line_dedup.dedup_lines(h.frame(spark, deep), min_lines=least)).set_index("doc_id")
        assert list(out.n_removed[[0, 1, 2]]) == [0, 37, 37] and list(out.lcp_lines) == [37] * 3 and out.longest_run[2] == 37
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(h.frame(spark, deep), min_lines=0)


def test_line_dedup_common_prefixes_and_repeated_ids(spark):
    import random

    r = random.Random(8)
    rows = [(i % 25, "\n".join(r.choice("abcd" if i % 3 else "ab") * 2 for _ in range(r.randint(0, 40))) or None, "en", "s", 1) for i in range(40)]
    rows += rows[:4] + [(100, "\n".join("xyz" * 30), "en", "s", 1), (101, "\n".join("xyz" * 29 + "q"), "en", "s", 1)]
    seqs = {(k, t): t.split("\n") for k, t, *_ in rows if t}
    at = [(d, p) for d, x in seqs.items() for p in range(len(x))]

    def shared(a, b):
        x, y = seqs[a[0]][a[1] :], seqs[b[0]][b[1] :]
        return next((i for i, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))

    want = {}
    for a in at:
        want[a[0]] = max(want.get(a[0], 0), *[shared(a, b) for b in at if b != a])
    for least in (1, 2, 3):
        out = line_dedup.dedup_lines(h.frame(spark, rows), min_lines=least).collect()
        assert len(out) == len(rows)
        # the text is gone, so documents are told apart by id and number of lines
        got = sorted((x.doc_id, x.n_lines, x.lcp_lines) for x in out)
        assert got == sorted((k, len(t.split("\n")) if t else 0, want.get((k, t), 0)) for k, t, *_ in rows)
        left = [x.text for x in out if x.text]
        windows = [tuple(t.split("\n")[i : i + least]) for t in {(x.doc_id, x.text) for x in out if x.text and x.n_removed == 0} for t in [t[1]] for i in range(len(t.split("\n")) - least + 1)]
        assert left and set(windows) <= {tuple(x[i : i + least]) for x in seqs.values() for i in range(len(x))}


def test_line_dedup_long_single_lines(spark, tmp_path):
    import corpus_pipeline

    long, short = " ".join(f"w{j}" for j in range(50)), " ".join(f"s{j}" for j in range(49))
    rows = [(1, f"a\n{long}\n{short}\nb", "en", "s", 1), (2, f"c\n \n{long}\nd\n{short}", "en", "s", 1), (3, f"{long}\ne\n{long}", "en", "s", 1)]
    rows += [(4, long, "en", "s", 1), (5, f"q\na\n{long}\nr", "en", "s", 1), (None, long, "en", "s", 1), (4, long, "en", "s", 1), (6, None, "en", "s", 1)]
    out = line_dedup.dedup_lines(h.clash(h.frame(spark, rows)), min_words=50)
    got = sorted((r.doc_id or 0, r.text or "", r.n_removed, r.longest_run, r.lcp_lines) for r in out.collect())
    assert got == [(0, long, 0, 0, 0), (1, rows[0][1], 0, 0, 2), (2, f"c\n \nd\n{short}", 1, 1, 1), (3, "e", 2, 1, 1), (4, "", 1, 1, 1), (4, "", 1, 1, 1), (5, "q\nr", 2, 2, 2), (6, "", 0, 0, 0)]
    kept = {r.doc_id: r.text for r in corpus_pipeline.dedup_lines(spark, h.frame(spark, rows), "").collect()}
    assert kept == {1: rows[0][1], 2: f"c\n \nd\n{short}", 3: "e", 5: "q\nr", None: long, 6: None}


def test_substring_repeated_rows_and_sketch_too_small(spark):
    rows = [*h.documents(5, 40), (0, h.documents(5, 40)[0][1], "en", "s", 1)]
    wide = h.pandas(substring.dedup_substrings(h.clash(h.frame(spark, rows)), 6, digest=True))
    tiny = h.pandas(substring.dedup_substrings(h.frame(spark, rows), 6, digest=True, max_bits=4))
    assert sorted(map(tuple, wide.values.tolist())) == sorted(map(tuple, tiny.values.tolist()))
    first = wide[wide.doc_id == 0]
    assert len(first) == 2 and first.kept_sha256.nunique() == 1


def test_decontaminate_several_passes_and_cut(spark):
    rows = h.documents(3, 30)
    rows += [(900, "so it goes Alpha, beta gamma DELTA sun moon river stone the of! and to in " + "rest " * 40, "en", "s", 1), (901, BENCH[0][1], "en", "s", 1), (902, "one", "en", "s", 1)]
    docs, bench = h.frame(spark, rows), spark.createDataFrame(BENCH, "item_id long, text string")
    many = sorted(map(repr, decontam.find_items(docs, bench, max_words=5).collect()))
    assert many == sorted(map(repr, decontam.find_items(docs, bench).collect()))
    out = {r.doc_id: r for r in decontam.decontaminate(h.clash(docs), bench).collect()}
    assert out[900].text.split()[:3] == ["so", "it", "goes"] and "beta" not in out[900].text and out[900].rest == "own rest"
    assert 901 not in out and 902 not in out and out[30].text is None
    left = decontam.find_items(spark.createDataFrame([(r.doc_id, r.text) for r in out.values()], "doc_id long, text string"), bench)
    assert left.where("n_hit > 0").count() == 0


def test_find_items_in_passes_by_row(spark):
    one, two = [f"a{i}" for i in range(10)], [f"b{i}" for i in range(10)]
    bench = spark.createDataFrame([(1, " ".join(one)), (2, " ".join(two)), (3, "zebra yak")], "item_id long, text string").coalesce(1)
    rows = [(1, " ".join(one), "en", "s", 1), (1, " ".join(["x", *two]), "en", "s", 1), (1, None, "en", "s", 1)]
    rows += [(None, " ".join([*two, *one]), "en", "s", 1), (None, "nothing", "en", "s", 1), (None, "a zebra yak", "en", "s", 1), (None, "a zebra yak", "en", "s", 1)]
    whole, many = [sorted(map(repr, decontam.find_items(h.clash(h.frame(spark, rows)), bench, max_words=n).collect())) for n in (500_000, 5)]
    assert whole == many and len(many) == len(rows)


def test_decontaminate_passes_judge_and_cut_as_one(spark):
    one, two = [f"a{i}" for i in range(10)], [f"b{i}" for i in range(10)]
    bench = spark.createDataFrame([(1, " ".join(one)), (2, " ".join(two)), (3, "zebra yak")], "item_id long, text string").coalesce(1)
    rows = [(1, " ".join(["x", *one[:10], "y", *two, "z", "u", "v"]), "en", "s", 1)]  # 10 of 25 words each, 20 of 25 together
    rows += [(2, " ".join([*[f"r{i}" for i in range(40)], *one[:5], "zebra yak", *one[5:], "tail"]), "en", "s", 1)]  # a later pass's cut joins an earlier one's window
    rows += [(3, None, "en", "s", 1), (None, "clean text", "en", "s", 1), (None, " ".join(["w"] * 30 + two), "en", "s", 1), *h.documents(3, 30)]
    docs = h.clash(h.frame(spark, rows))
    whole, many = [sorted(map(repr, decontam.decontaminate(docs, bench, max_words=n).collect())) for n in (500_000, 5)]
    assert whole == many
    got = [(r.doc_id, r.text) for r in decontam.decontaminate(h.frame(spark, rows[:5]), bench, max_words=5).collect()]
    assert (1, rows[0][1]) not in got and all(i != 1 for i, _ in got)
    assert sorted(t.split() for i, t in got if i in (2, None)) == sorted([[*[f"r{i}" for i in range(40)], "tail"], ["clean", "text"], ["w"] * 30])


def test_decontamination_items_without_an_id(spark, tmp_path):
    bench = [(None, BENCH[0][1]), (None, "zebra yak"), (7, "moon landing")]
    rows = [(1, "so " + BENCH[0][1] + " rest", "en", "s", 1), (2, "a zebra yak and a moon landing", "en", "s", 1), (3, "none", "en", "s", 1)]
    at = h.write(spark, tmp_path, rows, benchmark=(bench, "item_id long, text string"))
    h.same(queries.op6_decontamination(spark, at), *h.duck(at, queries.OP6_SQL, ("documents", "benchmark")))
    left = decontam.decontaminate(h.frame(spark, rows), spark.createDataFrame(bench, "item_id long, text string"), max_cover=1.0)
    assert sorted((r.doc_id, r.text.split()) for r in left.collect()) == [(1, ["so", "rest"]), (2, ["a", "and", "a"]), (3, ["none"])]


def test_jaccard_blocks_and_bounds(spark, monkeypatch):
    import random

    r = random.Random(4)
    rows, base = [], [f"t{j}" for j in range(60)]
    for i in range(40):  # a chain of near copies and some others
        base = [w if r.random() > 0.02 else f"n{i}x{j}" for j, w in enumerate(base)]
        rows.append((i, " ".join(base), "en", "s", 1))
    rows += [(100 + i, " ".join(r.choice(h.WORDS) for _ in range(r.randint(1, 60))), "en", "s", 1) for i in range(30)] + [(None, "x y z", "en", "s", 1), (5, rows[5][1], "en", "s", 1)]

    def brute(width, num, den):
        sets = {}
        for i, t, *_ in rows:
            if i is not None:
                w = t.lower().split()
                sets[i] = {tuple(w[j : j + width]) for j in range(max(1, len(w) - width + 1))}
        up = {i: i for i in sets}
        for _ in sets:
            for i in sets:
                for j in sets:
                    if den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                        up[i] = up[j] = min(up[i], up[j])
        return up

    for block in (1200, 6):
        monkeypatch.setattr(jaccard, "BLOCK", block)
        monkeypatch.setattr(jaccard, "LIST_BLOCK", block)
        for width, num in ((4, 85), (5, 80), (1, 60)):
            got = {x.doc_id: x.component_id for x in jaccard.near_duplicates(h.clash(h.frame(spark, rows)), width, num, 100).collect()}
            assert got.pop(None) is None
            assert got == brute(width, num, 100)
    kept = jaccard.drop_near_duplicates(h.frame(spark, rows), 4, 85, 100)
    assert {x.doc_id for x in kept.select("doc_id").collect()} == set(brute(4, 85, 100).values()) | {None}


def test_jaccard_frequent_hashes_make_no_large_lists(spark, monkeypatch):
    """A phrase that all share links nobody and makes no partition of all; a text of little else is read again."""
    phrase = " ".join(f"p{j}" for j in range(40))
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40)) + " " + phrase, "en", "s", 1) for i in range(300)]
    rows += [(i + 300, f"{phrase} {' '.join(f'v{i // 2}x{j}' for j in range(20))} {'end' * (i % 2)}", "en", "s", 1) for i in range(20)]
    rows += [(900, rows[7][1] + " end", "en", "s", 1), (901, phrase, "en", "s", 1), (902, phrase + " end", "en", "s", 1)]
    sizes, write = {}, jaccard.staged

    def counted(df, tag):
        out = write(df, tag)
        sizes[tag] = out.count()
        return out

    monkeypatch.setattr(jaccard, "LIST_BLOCK", 20)
    monkeypatch.setattr(jaccard, "staged", counted)
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(h.frame(spark, rows), 4, 85, 100).collect()}
    assert got == {i: i for i in range(300)} | {i + 300: i // 2 * 2 + 300 for i in range(20)} | {900: 7, 901: 901, 902: 901}
    assert 0 < sizes["jaccard-short"] and sizes["jaccard-members"] < 323


def test_jaccard_repeated_ids_with_other_texts(spark, monkeypatch):
    a, b, c = (" ".join(f"{x}{j}" for j in range(40)) for x in "abc")
    rows = [(9, a, "en", "s", 1), (9, b, "en", "s", 1), (10, a + " z", "en", "s", 1), (11, b + " z", "en", "s", 1), (5, c, "en", "s", 1), (5, "d", "en", "s", 1)]
    rows += [(1, "d", "en", "s", 1), (12, c, "en", "s", 1), (5, None, "en", "s", 1), (7, "", "en", "s", 1), (9, a, "en", "s", 1), (2, None, "en", "s", 1), (3, "e", "en", "s", 1)]
    want = sorted([(9, 9)] * 3 + [(10, 9), (11, 9), (5, 1), (5, 1), (5, 1), (1, 1), (12, 1), (7, 7), (2, 2), (3, 3)])
    for block in (1200, 2):
        monkeypatch.setattr(jaccard, "BLOCK", block)
        monkeypatch.setattr(jaccard, "LIST_BLOCK", block)
        out = jaccard.near_duplicates(h.clash(h.frame(spark, rows)), 4, 85, 100)
        assert sorted((r.doc_id, r.component_id) for r in out.collect()) == want
        kept = jaccard.drop_near_duplicates(h.clash(h.frame(spark, rows)), 4, 85, 100)
        assert sorted({r.doc_id for r in kept.collect()}) == [1, 2, 3, 7, 9]


def test_url_filter_in_shuffle_and_hot(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"https://h.example.com/en/{i % 7 if i > 300 else 1}", "") for i in range(900)], "page_id long, url string, html string")
    listed = spark.createDataFrame([("http://www.h.example.com/en/1.html",), (None,), ("http://h.example.com/en/3",), *[(f"http://z.example.org/{i}",) for i in range(500)]], "url string")
    one = url_filter.judge_urls(h.clash(pages), listed, queries.URL_RULES)
    monkeypatch.setattr(common, "BROADCAST_BLOCKS", 0)
    two = url_filter.judge_urls(pages, listed, queries.URL_RULES)
    assert sorted(one.collect()) == sorted(two.collect())
    blocked = {r.page_id for r in one.where("verdict = 'block'").collect()}
    assert blocked == {i for i in range(900) if (i % 7 if i > 300 else 1) in (1, 3)}
    none = url_filter.judge_urls(pages.limit(0), listed.limit(0), queries.URL_RULES)
    assert none.agg(F.count("page_id")).first()[0] == 0
