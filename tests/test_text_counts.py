"""Word and token counts: the classes that Java asks quickly hold the same characters."""

import time

import pandas as pd
from pyspark.sql import functions as F

from siftlane.functions import text as T


def test_every_character_counts_as_by_the_plain_patterns(spark):
    rows = [(f"a{c}1 b{c}{c}\t{c}",) for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) <= 0xDFFF]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["t"])).repartition(4)
    plain = lambda p: T._count_runs("t", p)
    same = (T.word_count("t") == plain(f"[^{T.WS_CLASS_BODY}]+")) & (T.count_tokens("t") == plain(T.TOKEN_COUNT_PATTERN))
    assert df.where(same).count() == len(rows)


def test_counting_does_not_ask_the_whole_list_of_white_space_for_each_letter(spark):
    df = spark.createDataFrame([("several words of plain prose, and so on. " * 2500,)] * 16, "t string").repartition(4).cache()
    df.count()

    def seconds(c):
        took = []
        for _ in range(3):
            began = time.time()
            df.agg(F.sum(c)).first()
            took.append(time.time() - began)
        return min(took)

    assert seconds(T.word_count("t")) < 0.5 * seconds(T._count_runs("t", f"[^{T.WS_CLASS_BODY}]+"))
