import hashlib
import re

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """A table of documents from texts, or from (doc_id, text) pairs."""
    def make(texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "s", -1) for i, t in rows], SCHEMA)
    return make


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


#: nulls, empty and blank texts, one word, ties, repeats, other scripts, long texts, odd characters
AWKWARD = [None, "", " \n\t", "word", "word", "Word  ", "a b", "é 日本語 \U0001f600 x", "x" * 5000, "lorem ipsum dolor sit amet " * 900,
           "lorem ipsum dolor sit amet " * 900, "\x00\x01 control", "a b c", "tab\tand\r\nline\x0b\x0c", "▁▁ mark ▁", "<0x0A> </s> <unk>", "#$%&*" * 40]
