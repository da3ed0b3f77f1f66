"""Small inputs that every operator must take."""
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

#: Null id, null text, empty text, white space, repeated rows, a repeated id
#: with another text, a long text, code points beyond Latin.
EDGE = [
    (1, "the quick brown fox jumps over the lazy dog"), (1, "the quick brown fox jumps over the lazy dog"),
    (2, None), (3, ""), (4, " \n\t "), (None, "no id here at all"), (None, None),
    (5, "the quick brown fox jumps over the lazy dog"), (5, "der schnelle braune Fuchs"),
    (6, "long words and more of them " * 4000), (7, "中文 и русский текст \U0001f642 née"), (8, "1234 5678 !!"), (9, "x" * 3000),
]


def edge_docs(spark, *names):
    """EDGE with columns whose names clash with the operators' own."""
    df = spark.createDataFrame(EDGE, "doc_id long, text string")
    return df.withColumns({n: F.lit("clash") for n in (*names, "id", "node", "score", "rank")})


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def docs_of(spark, sf=SF):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
