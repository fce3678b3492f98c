import random

import pytest

WORDS = "the of tion hea ing ond er ouble ésh über the, and. Was ATE".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Copies, near copies, empty, null, blank, long and short texts."""
    rng = random.Random(5)
    base = [prose(rng, n) for n in (3, 4, 5, 6, 12, 30, 60, 120, 400, 9000)]
    out = base + [base[6], base[6].upper(), base[3], base[3], None, "", "  \n\t ", "x", "X"]
    for b in base[4:9]:
        words = b.split()
        for k in range(6):
            w = list(words)
            for _ in range(k):
                w[rng.randrange(len(w))] = f"new{rng.randrange(999)}"
            out.append(" ".join(w))
    shared = prose(rng, 40)
    out += [f"{shared} {prose(rng, 25)}" for _ in range(70)]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """documents with columns that clash with the operators' own."""
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 7}" if i % 11 else None, 0, 9, "z", "h", 1.5)
            for i, t in enumerate(texts)]
    rows += [rows[10], rows[10], (None, texts[10], "en", "src1", 0, 9, "z", "h", 1.5), (None, None, None, None, 0, 9, "z", "h", 1.5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "n long, kept string, h string, score double").repartition(5)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
