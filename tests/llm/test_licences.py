from compare import compare, duck
from helpers import clashing, edge_docs, empty, rows

from conftest import SF001
from ledgerloom.llm import licences

GRANT, NOTICE, WARRANTY = (licences.SENTENCES[k] for k in ("mit-grant", "mit-notice", "mit-warranty"))


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_rules(spark):
    wrapped = GRANT.replace(" to any person", "\nto any person").replace("without restriction", "without\nrestriction")
    texts = [
        f"Some words\n{licences.SENTENCES['mit-line']}\nmore words",
        f"{wrapped}\n\n{NOTICE}\n\n{WARRANTY}\n",
        f"{GRANT}\n{NOTICE}",
        f"{NOTICE}\n{GRANT}",  # wrong order
        f"{GRANT}\n{licences.SENTENCES['cc-by-4-line']}\n{NOTICE}",  # another sentence between
        "LICENSED   under the apache license -- version 2.0!",
        f"{licences.SENTENCES['mit-line']} {licences.SENTENCES['mit-line']}",
        "Licensed under CC BY-NC 4.0 or so.",
    ]
    got = rows(licences.scan(docs(spark, texts)))
    assert got == [(0, "MIT", 1, 1), (1, "MIT", 3, 1), (2, "MIT", 2, 1), (4, "CC-BY-4.0", 1, 1), (5, "Apache-2.0", 1, 1), (6, "MIT", 1, 2)]


def test_documents_against_sql(spark):
    ok, said = compare(licences.scan(spark.read.parquet(f"{SF001}/documents.parquet")), duck(SF001), licences.oracle())
    assert ok, said


def test_edge_cases(spark):
    d = edge_docs(spark)
    assert rows(licences.scan(clashing(d))) == rows(licences.scan(empty(d))) == []
    line = licences.SENTENCES["gpl-3-line"]
    odd = spark.createDataFrame([(None, line), (None, line), (1, line), (1, "x. " * 100_000 + line)], "doc_id long, text string")
    assert rows(licences.scan(odd)) == [(1, "GPL-3.0", 1, 1), (None, "GPL-3.0", 1, 1)]
