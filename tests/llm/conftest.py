import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A small documents table from (doc_id, text, lang, source) rows."""

    def make(rows):
        full = [(*r, *([None] * (4 - len(r))), None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make


@pytest.fixture(scope="session")
def path_of():
    import public_tokenizers

    return public_tokenizers.path


#: Texts that every operator must handle: null, empty, blank, one word, no word, other scripts, control characters, long.
ODD = [None, "", " ", "\n\n", "word", "!!! ???", "日本語 のテキスト 😀", "a\x00b\tc", "é" * 70, "lorem ipsum " * 3000, "x" * 20000]


@pytest.fixture(scope="session")
def odd(docs_of):
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None) for i, t in enumerate(ODD)]
    return docs_of([*rows, rows[4], (None, "word", None, None)])


@pytest.fixture(scope="session")
def empty(docs_of):
    return docs_of([])
