"""The check of a copied data set: one pass over the keys, and what an append moves and writes."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strandline.functions.jsons import digest_of, read_document, text_digest
from strandline.operators import checks as K
from strandline.operators import subgraphs as S
from strandline.plans import check as C
from strandline.plans.store import Store
from strandline.session import LANDED
from tests.conftest import values

PROCESS = ('{"links":[{"link_type":"process_link","process_type":"process","process_id":"%s","inputs":[{"input_type":"cell_line","input_id":"c"}],'
           '"outputs":[{"output_type":"links","output_id":"%s"}],"protocols":[]}]}')
ROWS = "entity_type string, entity_id string, project_id string, content string"
SOUND = [("links", "l1", "P", PROCESS % ("p1", "l2")), ("links", "l2", "P", PROCESS % ("p2", "l1")), ("project", "P", None, "{}"),
         ("process", "p1", None, "{}"), ("process", "p2", None, "{}"), ("cell_line", "c", None, "{}")]


def rows_of(spark, rows):
    rows = spark.createDataFrame(rows, ROWS)
    return rows.withColumns({"version": F.lit("2024-01-01").cast("timestamp"), "file_id": F.lit("f"), "descriptor": F.lit("{}"), "row_id": F.expr("uuid()")})


CASES = [SOUND, SOUND * 2, SOUND[1:], SOUND[:-1], SOUND[:-2] + SOUND[-1:], SOUND[:2] + SOUND[3:], [*SOUND, ("links", "l3", "P", "{}")],
         [*SOUND[:-1], ("links", "l3", "Q", "{}")], [*SOUND, ("links", None, "P", PROCESS % ("p1", "l2"))], [*SOUND, ("links", "l4", None, PROCESS % ("p1", "gone"))],
         SOUND[2:], [*SOUND, (None, "c", None, "{}"), ("cell_line", None, None, "{}")]]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_an_audit_finds_what_the_checks_find(spark, case):
    rows = rows_of(spark, CASES[case])
    found = K.audit(rows).first()
    assert values(K.audit(rows).drop("fault")) == values(K.problem_counts(rows))
    want = S.first_fault(S.links_of(rows), rows)
    assert (found.fault is None) == (want is None)
    if want:
        row, unreadable = want
        assert found.fault.unreadable == unreadable
        assert unreadable or [(found.fault.entity_type, found.fault.entity_id)] == [(row["entity_type"], row["entity_id"])]


def test_a_copy_is_checked_in_one_pass(spark, folder):
    """The keys of all rows were shuffled twice, and stored."""
    store = Store(spark, folder)
    rows = rows_of(spark, SOUND).drop("row_id")
    store.append(rows)
    n_landed = len(LANDED)
    assert not C.require_copy(store, "P").first().has_problems
    assert [spark.read.parquet(path).count() for path in LANDED[n_landed:]] == [1]
    with pytest.raises(S.SubgraphError, match="projects differ"):
        C.require_copy(store, "Q")
    store.append(rows)
    with pytest.raises(C.DatasetProblems, match="duplicates"):
        C.require_copy(store, "P")
    store.append(rows_of(spark, [("links", "l9", "P", PROCESS % ("gone", "l1"))]).drop("row_id"))
    with pytest.raises(S.SubgraphError, match="not loaded.*'gone'"):
        C.require_copy(store, "P")
    store.append(rows_of(spark, [("links", "l8", "P", "{}")]).drop("row_id"))
    with pytest.raises(S.SubgraphError, match="unreadable.*'l8'"):
        C.require_copy(store, "P")


def test_stored_rows_are_halved(spark, folder):
    """Digests and ids, which are hexadecimal, were stored as long as they are."""
    store = Store(spark, folder)
    rows = spark.range(20_000).select(F.lit("project").alias("entity_type"), F.col("id").cast("string").alias("entity_id"),
                                      F.lit("2024-01-01").cast("timestamp").alias("version"), F.concat(F.lit('{"a":'), "id", F.lit("}")).alias("content"))
    store.append(rows.repartition(4))
    files = [pq.ParquetFile(path) for path in glob.glob(f"{folder}/rows/**/*.parquet", recursive=True)]
    assert sum(file.metadata.row_group(k).total_byte_size for file in files for k in range(file.metadata.num_row_groups)) > 2_000_000
    stored = sum(column.total_compressed_size for file in files for k in range(file.metadata.num_row_groups)
                 for column in map(file.metadata.row_group(k).column, range(file.metadata.num_columns)))
    assert stored < 20_000 * 70  # 100 characters of an id and a digest, and the rest
    for file in files:
        ids = file.read(["entity_id"]).column(0).to_pylist()
        assert ids == sorted(ids)
    found = store.raw().select("content", "content_digest", "row_id").collect()
    assert all(row.content_digest == text_digest(row.content) for row in found) and len({row.row_id for row in found}) == 20_000


@pytest.mark.parametrize("depth", [5, 290, 310, 600])
def test_a_digest_is_the_same_in_one_piece_and_in_parts(depth):
    text = '{"b":[1.0,-0.0,1e3,2.5],"a":' + "[" * depth + '"\\u00e9\\ud800"' + "]" * depth + "}"
    assert text_digest(text) == digest_of(read_document(text))
