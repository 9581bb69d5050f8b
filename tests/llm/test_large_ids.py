"""Ids near 2^62 beside a null id come back whole from every operator with Python tasks."""

from flowtables.llm import minhash, quality, suffixes, trainorder

LARGE = 2**62 + 1
TEXT = " ".join(f"word{i}" for i in range(120))
ROWS = [(LARGE, TEXT), (None, "quite another text"), (LARGE + 2, TEXT), (LARGE + 4, "one more text of its own")]


def test_large_ids_beside_a_null_id(spark, folder):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").coalesce(1)
    ids = {r[0] for r in ROWS}
    near = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs).collect()}
    assert near == {LARGE: LARGE, None: None, LARGE + 2: LARGE, LARGE + 4: LARGE + 4}
    assert {r["doc_id"] for r in minhash.without_near_duplicates(docs).collect()} == ids - {LARGE + 2}
    removed = {r["doc_id"]: r["n_removed"] for r in suffixes.without_repeats(docs).collect()}
    assert removed == {LARGE: len(TEXT), None: 0, LARGE + 2: len(TEXT), LARGE + 4: 0}
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["doc_id"] for r in quality.scored(docs, labels).collect()} == ids
    with open(folder + "/ranks", "w") as f:
        import base64

        f.writelines(f"{base64.b64encode(bytes([b])).decode()} {b}\n" for b in range(256))
    assert {r["doc_id"] for r in trainorder.tokenised(docs, folder + "/ranks").collect()} == ids
