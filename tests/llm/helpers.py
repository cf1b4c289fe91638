"""Small tables with the awkward rows every operator must take."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names the operators use themselves
    T.StructField("uid", T.StringType()), T.StructField("fp", T.StringType()), T.StructField("size", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("doc", T.StringType()), T.StructField("guess", T.StringType())])

EXTRA = ("u", "f", "s", "c", "d", "g")

EN = "the ring was there and then the thing that was here in the morning with other things"
DE = "der ring und die sache ist heute nicht mehr da und das wetter wird auch schlecht werden"


def docs_frame(spark, rows):
    """Rows of (doc_id, text, lang, source)."""
    return spark.createDataFrame([(i, t, la, s, len(t) if t else None, *EXTRA) for i, t, la, s in rows], DOCS)


def awkward(spark):
    long = " ".join(f"wort{i % 977} the" for i in range(30_000))
    return docs_frame(spark, [
        (1, EN, "en", "a"), (2, EN, "en", "a"), (2, EN, "en", "a"), (3, DE, "de", "b"), (4, None, "de", None), (5, "", None, "b"),
        (6, "  \t\n ", "en", ""), (None, EN + " x", "en", "a"), (None, None, None, None), (7, long, "en", "a"), (8, "12345 !!", "en", "c"),
        (9, "é", "fr", "c"), (10, "one", "en", "c"), (11, DE + "  zwei\tleer  ", "de", "b")])


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
