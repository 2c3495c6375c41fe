"""Small fixtures with the awkward cases, and brute-force versions."""

import random
import re

import duckdb
import pandas as pd

WORDS = "alpha beta gamma delta sun moon river stone é ñandú straße 42 the of and to in it is as at on by".split()


def text(r, n, lines=True):
    out = []
    for _ in range(n):
        out.append(r.choice(WORDS))
        out.append(r.choice([" ", " ", " ", "  ", "\n" if lines else " ", "\t", ". "]))
    return "".join(out)


def documents(seed=1, n=60):
    """(doc_id, text, lang, source, n_chars) with copies, shared passages, nulls, blanks, and a very long text."""
    r = random.Random(seed)
    shared = "\n".join(text(r, 12, False) for _ in range(4))
    rows = []
    for i in range(n):
        kind = r.randrange(7)
        t = text(r, r.randint(0, 90))
        if kind == 0 and rows:
            t = r.choice(rows)[1]
        elif kind == 1 and rows and rows[-1][1]:
            t = rows[-1][1] + " more"
        elif kind == 2:
            t = t + "\n" + shared + "\n" + text(r, 10)
        elif kind == 3:
            t = "\n".join([text(r, 6, False)] * 3) + "\n" + t
        rows.append((i, t, "en", f"src{i % 3}", len(t or "")))
    long = text(r, 6000)
    rows += [
        (n, None, "en", "src0", None),
        (n + 1, "", "en", None, 0),
        (n + 2, " \n\t \n", "en", "src1", 5),
        (n + 3, "one", "en", "src1", 3),
        (n + 4, "one", "en", "src1", 3),
        (n + 5, "One  Two", "en", "src1", 8),
        (n + 6, "one two", "en", "src2", 7),
        (n + 7, long, "en", "src2", len(long)),
        (n + 8, long + " end", "en", "src2", len(long) + 4),
        (n + 9, "a\nb\na\nb\na\nb", "en", "src2", 11),
    ]
    return rows


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def write(spark, path, rows, **others):
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    for name, (data, schema) in others.items():
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def duck(path, sql, tables=("documents",)):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet/*.parquet'")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    return names, got.fetchall()


def same(df, names, rows):
    cols = sorted(df.columns)
    assert cols == sorted(names)
    at = [names.index(c) for c in cols]
    mine = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    theirs = sorted((tuple(r[i] for i in at) for r in rows), key=repr)
    assert mine == theirs


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def clash(df):
    """Extra columns under names that operators use inside."""
    from pyspark.sql import functions as F

    for c in ("k", "b", "n", "t", "host", "starts", "n_words", "n_lines", "kept", "component_id", "block", "rest", "__k", "__starts", "__gone", "__lcp", "__rest", "r", "x", "a.b"):
        df = df.withColumn(c, F.lit(f"own {c}"))
    return df


def pandas(df):
    return pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns)
