import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(rows):
    """Documents from texts (or (text, lang, source)), ids from 0."""

    def make(*items, start=0):
        data = [(i, *(t if isinstance(t, tuple) else (t, "en", "s"))) for i, t in enumerate(items, start)]
        return rows(DOCS, *[(i, t, lang, source, len(t or "")) for i, t, lang, source in data])

    return make


@pytest.fixture
def save(tmp_path):
    """Writes tables as a folder that queries read."""

    def write(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
