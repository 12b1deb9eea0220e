"""Small document tables with every awkward case, shared by the operators' tests."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: Extra columns whose names clash with internal ones.
CLASHING = "doc_id long, text string, row long, _row string, _score string, _keys int, h int, n long, key string, node int"


def prose(rng: random.Random, words: int) -> str:
    out = []
    for i in range(words):
        w = "".join(rng.choice(["an", "the", "ou", "lé", "st", "ü", "re", "ion"]) for _ in range(rng.randint(1, 4)))
        out.append(w.capitalize() if rng.random() < 0.1 else w + rng.choice(["", "", "", ",", ".", ".\n"]))
    return " ".join(out)


def awkward_texts(seed: int = 0) -> list[str | None]:
    rng = random.Random(seed)
    base = prose(rng, 120)
    words = base.split(" ")
    near = " ".join([*words[:60], "changed", *words[61:]])
    passage = prose(rng, 70)
    line = "A line that many documents share, over forty characters."
    out: list[str | None] = [None, "", " ", "one", "two words", base, base, near, near + " tail", "a" * 450, "ab" * 300, base.upper(), "日本語のテキスト、分かち書きなし。" * 30, "\U0001f600 emoji ▁ and  two  blanks ", "\n\n" + line + "\n", "x\x00y"]
    out += [f"{prose(rng, 20)} {passage} {prose(rng, 20)}" for _ in range(4)]
    out += [f"{prose(rng, 5)}\n {line.upper() if i % 2 else line} \nend {i}" for i in range(7)]
    out += [prose(rng, rng.randint(1, 60)) for _ in range(20)]
    out.append(prose(rng, 9000))
    return out


def documents(spark: SparkSession, texts: list[str | None], clashing: bool = False) -> DataFrame:
    rows = list(enumerate(texts))
    if not clashing:
        return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return spark.createDataFrame([(i, t, 1, None, "s", 5, None, 0, "k", 1) for i, t in rows], CLASHING).repartition(3)
