"""Small documents with every awkward case, and slices of the test tables."""

import random

import pytest

DATA = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, "
          "shard int, fp long, u long, v long, start long, key long, tokens long, topic string, "
          "prob double, passage string, digest string, seq int")
EXTRA = (7, 1, 2, 3, 4, 5, 6, 8, "odd", 0.5, "p", "d", 9)


def words(rng: random.Random, n: int, letters: str = "abcdefghij") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8)))
                    for _ in range(n))


def edge_rows() -> list[tuple]:
    rng = random.Random(1)
    plain = words(rng, 60)
    texts = [plain, None, "", "  \n\t \x0b", plain, plain + " tail", "word", "ü ß 漢字 🙂 " * 3,
             words(rng, 9000), "a" * 50_000, "\x00 |*#$ 12 34", "Released under the MIT License."]
    rows = [(i * 50, t, ["en", "de", None][i % 3], ["s0", "s0", "s1", None][i % 4],
             None if t is None else len(t), *EXTRA) for i, t in enumerate(texts)]
    rows.append(rows[0])                                        # a repeated row
    rows.append((rows[1][0], plain, None, None, None, *EXTRA))  # an id twice, other text
    rows.append((None, plain, "en", "s0", None, *EXTRA))        # no id
    return rows


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{DATA}/benchmark.parquet")
