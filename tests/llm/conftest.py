import pytest

from lotwise.llm.inputs import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bits string, node long"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with columns that clash with the operators' own."""
    prepare(spark)

    def make(texts: dict):
        rows = [
            (k, t, "en", f"site{i % 12}", len(t or ""), "x", 1)
            for i, (k, t) in enumerate(texts.items())
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def texts():
    """Nulls, empty and very long texts, copies, near copies, a common line."""
    base = " ".join(f"w{i}" for i in range(400))
    out = {i: base.replace(f"w{i * 7} ", f"x{i} ") for i in range(30)}
    out |= {40: base, 41: base, 50: None, 51: "", 52: "one two", 53: "one two", 54: " \n\t "}
    out |= {i: f"a common line of words\nown text {i} " + f"only{i} " * 30 for i in range(60, 75)}
    out[90] = " ".join(f"long{i % 9999}" for i in range(60_000))
    return out
