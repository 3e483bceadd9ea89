"""Small tables with the cases every operator must bear, and brute-force versions."""

from __future__ import annotations

import random

from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


def texts(seed: int = 1) -> list[str | None]:
    r = random.Random(seed)
    words = ["the", "tion", "Éau", "de", "lln", "ñas", "Straße", "x", "1999", "don't", "AB", "!!", "$$$", "日本語", "ét", "İz", "ΑΣ"]

    def some(n: int) -> str:
        return " ".join(r.choice(words) + r.choice(["", "", "", ",", ".", "\n"]) for _ in range(n))

    passage, license_line = some(90), some(60)
    out: list[str | None] = [None, "", " ", "  ", "\n", "a", "a ", " a", "a  b", "a   b", "a \n b", "a\n  b  ", "x▁y", "▁", "\x1ca\x1db", "a\x85b", "<|endoftext|>", "a<|endoftext|> b", "<|startoftext|>x <|ENDOFTEXT|>", "\ta\t\tb", "a b", " q"]
    for _ in range(12):
        out.append(some(r.randint(1, 120)))
    base = some(150)
    out += [base, base, base, base.replace("the", "teh", 1), some(20) + passage + some(30), some(40) + passage, passage, license_line + some(50), some(33) + license_line]
    out += ["a" * 700, "ab" * 400, some(6000), some(40) * 6]
    return out


def frame(spark: SparkSession, rows: list[str | None]):
    data = [(i * 3 + 1, t, f"s{i % 4}" if i % 7 else None, i) for i, t in enumerate(rows)]
    data += [data[-1], (None, rows[-1], "s1", 5), (None, None, None, None), (-4, "the end of it", "s1", 1)]
    return spark.createDataFrame(data, "doc_id long, text string, source string, size long").repartition(5)
