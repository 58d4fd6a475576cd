"""Steps that read every character of all rows: the same as plain versions, and quick enough for many rows."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from pagewright.llm.p2_lookalikes import PLAIN, PLAIN_ROW

# the characters of plain rows as one list of ranges
LISTED = (
    r"[\t\n\r -~¡-§©«®°±¶»¿À-ıŃ-ňŊ-žƏƠ-ơƯ-ưऀ-ॗॠ-ॿ،-؛؞-ٯٱ-ٴٹ-ۿก-๛"
    r"、-〭ぁ-ゖゝ-ゞァ-ヾ一-鿿–—‘’‚“”„†‡•…‰‹›€·×÷&&[^ıſĲĳĿŀŉक़-य़ٵ-ٸ]]"
)


def test_plain_rows_are_of_the_same_characters(spark):
    each = spark.range(1, 0x110000).where("id not between 55296 and 57343 and id <> 65279").select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    assert each.where(F.col("c").rlike(PLAIN_ROW) != F.col("c").rlike(rf"\A{LISTED}*\z")).count() == 0
    assert each.where(F.col("c").rlike(PLAIN_ROW)).count() == sum(ord(b) - ord(a) + 1 for a, b in PLAIN)
    rows = spark.createDataFrame([("",), ("plain\r\nرجل",), ("plain\n",), ("plain\x0b",), ("aо",), ("😀",)], "t string")
    assert [r[0] for r in rows.select(F.col("t").rlike(PLAIN_ROW)).collect()] == [True, True, True, False, False, False]


def test_plain_rows_are_told_as_fast_as_words_are_parted(spark):
    text = "Az öreg kovács a híd mellett állt, és őrizte a várat. " * 2 + "وقف الحداد العجوز بجانب الجسر. ช่างเหล็กพูด 老铁匠站在桥边。"
    rows = spark.range(0, 60_000, 1, 2).select(F.concat(F.lit(text), F.col("id").cast("string")).alias("t"))

    def took(step) -> float:
        times = []
        for _ in range(4):
            began = time.perf_counter()
            rows.select(step.alias("x")).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        return min(times)

    assert took(F.col("t").rlike(PLAIN_ROW)) < 1.5 * took(F.size(F.split(F.lower("t"), r"[^\p{L}\p{M}]+")))
