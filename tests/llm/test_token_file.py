"""What a task of the token files holds at once."""

from lakeloom.llm import token_file
from lakeloom.llm.common import BATCH_BYTES, BATCH_ROWS, scratch_dir
from lakeloom.llm.token_file import tokenizer_path


def test_texts_arrive_in_small_batches(spark):
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    for name in names:
        spark.conf.unset(name)
    docs = spark.createDataFrame([(k, "some words " * 20) for k in range(50)], "doc_id long, text string")
    token_file.write_token_files(docs, scratch_dir(spark, "t"), tokenizer_path("word_bpe_49k.json"), lowers=True, end=2)
    assert [int(spark.conf.get(name)) for name in names] == [BATCH_ROWS, BATCH_BYTES]
