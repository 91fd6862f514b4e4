"""Tables that the tests of the training-data operators share."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

LINE = " ".join(f"w{i}x" for i in range(50))


def edge_rows():
    """(doc_id, text): nulls, blanks, repeated rows and texts, a null id, very long texts."""
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "..."), (5, "house"), (6, "house"), (7, "The cat sat on the mat and the dog ran."),
        (7, "The cat sat on the mat and the dog ran."), (8, "Été à la plage, übermäßig schön! 漢字 🎉"), (None, "a text without an id of its own"),
        (9, "word " * 30_000), (10, "x" * 120_000), (11, "start " + LINE + " one end"), (12, "other " + LINE + " two end"), (13, LINE + "\n" + LINE),
        (14, "password=9f86d081884c7d659a token = \"aabbccddeeff00112233445566778899aabbccdd\""), (15, "1 2 3 4 5 6 7 8 9 0 +1 (555) 555-0100 a@b.co"),
    ]


def edge_documents(spark):
    """edge_rows() with extra columns, some named like the operators' own."""
    df = spark.createDataFrame(edge_rows(), "doc_id long, text string")
    names = ("fp", "k", "pos", "h", "ids", "row", "key", "score", "_k", "_may", "_starts", "spans", "c", "block", "held_out", "node", "a.b")
    return df.withColumns({n: F.lit(f"extra {n}") for n in names}).withColumns({
        "lang": F.lit(None).cast("string"), "source": F.lit("src"), "n_chars": F.length("text").cast("long")})


def sf_documents(spark, sf=SF):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


def roots(ids, links):
    """The least id reachable from each id."""
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        top[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
