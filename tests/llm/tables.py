"""Small tables for the tests."""

from pyspark.sql import types as T

TESTDATA = "/root/testdata"
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def documents(spark, *texts, **columns):
    """A table of documents: doc_id by place, the same source and language for all unless given."""
    rows = [
        (
            columns.get("ids", range(len(texts)))[i],
            text,
            columns.get("langs", ["en"] * len(texts))[i],
            columns.get("sources", ["s"] * len(texts))[i],
            None if text is None else len(text),
        )
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def prose(chance, words, vocabulary=5000):
    """So many invented words, in sentences of ten or so."""
    out = []
    for i in range(words):
        out.append("w" + "".join("aeioubcdfg"[int(d)] for d in str(chance.randrange(vocabulary))))
        if i % 10 == 9:
            out[-1] += "."
    return " ".join(out)


def by_id(frame, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in frame.collect()}
