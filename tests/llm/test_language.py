from pyspark.sql import functions as F

from tidemark.llm import language
from tidemark.llm.queries import op7_language_id, table

SF_DIR = "/root/testdata/sf0.01"


def test_texts_left_out_are_told(spark):
    docs = table(spark, SF_DIR, "documents")
    got = op7_language_id(spark, SF_DIR).join(docs.select("doc_id", "lang"), "doc_id")
    row = got.where("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")
    ).first()
    assert row[0] > 0.98 and 0 <= row[1] and row[2] <= 1


def test_labels_held_out_are_not_learnt(spark):
    docs = table(spark, SF_DIR, "documents")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    other = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    key = ["doc_id", "held_out", "lang_pred", "score"]
    assert language.identify(other).select(key).exceptAll(language.identify(docs).select(key)).count() == 0


def test_letters_decide_what_is_unknown():
    assert [language.has_letter(t.encode()) for t in ("", "12 ²½", "_-", "é", "日")] == [
        False, False, False, True, True,
    ]
    assert not language.has_letter(None)
