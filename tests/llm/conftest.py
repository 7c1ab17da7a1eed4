import pytest

SCHEMA = "doc_id long, text string, lang string, source string, digest string, key long, row string"


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in any column, empty and long texts, copies, near copies, a
    repeated row, and extra columns that share the operators' own names."""
    base = " ".join(f"w{i}" for i in range(120))
    near = base.replace("w7 ", "x7 ")          # 5 of 116 shingles differ
    far = " ".join(f"w{i}" if i % 9 else f"y{i}" for i in range(120))
    long = " ".join(f"word{i % 997} t{i}" for i in range(6000))
    texts = [base, base.upper(), near, far, None, "", "  \t", "a b", "A B", "one", long, long,
             "é É ß <|endoftext|> ² it's 3.5 naïve", base, near + " tail"]
    rows = [(i, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 3}", "x", 1, "r")
            for i, t in enumerate(texts)]
    rows += [rows[2], (None, base, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
