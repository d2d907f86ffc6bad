import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, body int, key double, kept boolean, score string, word string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents with columns whose names the operators use themselves."""
    def build(pairs):
        rows = [(i, t, None if k % 3 else "en", f"src{k % 2}", None if t is None else len(t), "x", k, 0.5, None, "s", "w")
                for k, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(rows, SCHEMA)
    return build


@pytest.fixture(scope="session")
def odd():
    """Nulls, blanks, very long and repeated texts, ties."""
    r = random.Random(5)
    names = ["".join(r.choices("abcdefghij", k=r.randint(1, 7))) for _ in range(400)]

    def words(n):
        return " ".join(r.choices(names, k=n))

    base = words(130)
    cut = base.split()
    near = [" ".join(cut[:k] + ["changed"] + cut[k + 1:]) for k in (20, 60, 100)]
    far = " ".join(cut[:65]) + " " + words(65)
    return [
        (1, base), (2, base), (3, base.replace(" ", " \t\n")), (4, near[0]), (5, near[1]), (6, near[2]), (7, far), (8, words(90) + " " + " ".join(cut[10:75])),
        (9, None), (10, ""), (11, " \n\t "), (12, "one"), (13, "ONE"), (14, "two words"), (15, words(60_000)), (16, "x" * 300_000),
        (17, "Café ÄÖ don't 12345 <|endoftext|> 中文 \U0001f642   end"), (18, words(49)), (19, words(50)), (20, words(51)), (None, base), (None, None),
        (21, words(300)), (21, None), (22, " ".join(["same"] * 200)),
    ][:-2] + [(22, " ".join(["same"] * 200)), (22, " ".join(["same"] * 200))]
