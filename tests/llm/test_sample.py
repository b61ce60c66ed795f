"""The training sample that reaches the driver is no larger than asked for, and is that of the lowest hashes."""

import hashlib

from pyspark.sql import functions as F

from cartwise.llm import pii


def test_driver_gets_the_windows_and_no_more(spark, monkeypatch):
    docs = spark.range(30_000).select(F.format_string("to a%d@b.com", "id").alias("text"))
    fetched, shown = [], []
    kind = type(docs)
    own = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: fetched.append((self.columns, own(self))) or fetched[-1][1])
    never = pii.train([])
    monkeypatch.setattr(pii, "train", lambda examples: shown.extend(text for text, _ in examples) or never)
    pii.fit(docs, 9)
    assert [len(rows) for columns, rows in fetched if "piece" in columns] == [9]
    place = lambda text: hashlib.sha1(text.encode()).hexdigest()
    lowest = sorted((f"to a{i}@b.com" for i in range(30_000)), key=place)[:9]
    trained = [t for t in lowest if int(place(t)[-4:], 16) % pii.HELD_OUT]
    assert shown[::1 + pii.VARIANTS] == trained and len(shown) == len(trained) * (1 + pii.VARIANTS) and 0 < len(trained) < 9
