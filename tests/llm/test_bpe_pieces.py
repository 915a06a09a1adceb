import pyarrow as pa

from weftline.llm import bpe


def test_ids_leave_in_pieces():
    """A batch of many texts goes back in pieces of at most 500 rows, in order, nothing lost."""
    whole = pa.RecordBatch.from_arrays([pa.array(range(2600)), pa.array([f"text {i}" for i in range(2600)])], ["doc_id", "t"])
    asked = []
    got = list(bpe._replaced(iter([whole, whole.slice(0, 0)]), ["doc_id", "ids"], lambda texts: asked.append(len(texts)) or texts))
    assert max(asked) <= 500 and sum(asked) == 2600
    assert pa.Table.from_batches(got).to_pylist() == [{"doc_id": i, "ids": f"text {i}"} for i in range(2600)]
