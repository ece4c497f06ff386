"""What a Python worker keeps from one operator's tasks to the next."""

import pyarrow as pa

from tidemark.llm import sentencepieces, workers
from tidemark.llm.queries import PIECES, vocabulary


def one_batch():
    return iter([pa.record_batch({"a": [1]})])


def test_a_model_stays_for_its_operator_and_goes_with_the_next_one():
    path = vocabulary(PIECES)
    model = sentencepieces.transducer(path)
    same = workers.tidy("sentencepieces", lambda batches: batches)
    assert [b.num_rows for b in same(one_batch())] == [1]
    assert sentencepieces.transducer(path) is model
    other = workers.tidy("simhash", lambda batches: batches)
    assert [b.num_rows for b in other(one_batch())] == [1]
    assert not workers._kept.get("sentencepieces")
    assert sentencepieces.transducer(path) is not model


def test_an_idle_worker_holds_no_memo_of_the_stage_before(spark):
    """As in the pipeline: sentencepiece tasks, then those of another operator in the same workers."""

    def names(batches):
        held = len(workers._kept.get("sentencepieces", ()))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([held] * batch.num_rows, pa.int64())], names=["held"])

    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string").coalesce(1)
    assert sentencepieces.encode(docs, vocabulary(PIECES)).count() == 1
    held = docs.select("doc_id").mapInArrow(workers.tidy("substrings", names), "held long")
    assert [r["held"] for r in held.collect()] == [0]
