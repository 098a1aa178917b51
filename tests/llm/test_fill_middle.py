"""Prefix, suffix and middle: against slicing of strings, and back."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import fill_middle
from tallyhouse.llm import text as tx
from tests.llm.cases import documents, odd_rows, prose, with_clashes


def expected(doc_id, text, fim=100, spm=50):
    text = text or ""
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim:
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


NASTY = ["\n", "\n\n\n", "a\n", "\na", "a\nb", "<P>", "x\n<M>\n", "<P\n>", "P>\n<S\n>M>\n<", "<", "é\n字\n\U0001f600", "<p>\n<S >", "\r\n\r", "<P><"]


def rows():
    out = odd_rows() + [(100 + i, t, "en", "a", 1) for i, t in enumerate(NASTY)]
    out += [(200 + i, "\n".join(prose(i * 50 + k, k % 9) for k in range(i)), "en", "a", 1) for i in range(60)]
    return out


@pytest.mark.parametrize("fim, spm", [(100, 50), (50, 50), (0, 50), (100, 0)])
def test_outputs_are_those_of_slicing(spark, monkeypatch, fim, spm):
    monkeypatch.setattr(tx, "SLICE_BYTES", 97)  # many chunks in a text, many texts in a chunk
    made = fill_middle.transform(with_clashes(documents(spark, rows())), fill_middle.Shares(7, fim, spm))
    found = [tuple(r) for r in made.collect()]
    wanted = [(r[0], *expected(r[0], r[1], fim, spm)) for r in rows()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    back = fill_middle.restore(made.withColumn("restored", F.lit(1))).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.restored) for r in back) == sorted(
        (r[0] is None, r[0] or 0, r[1] or "") for r in rows()
    )


def test_digests(spark):
    found = {r.doc_id: r for r in fill_middle.digest(documents(spark, [(1, "a\nb\nc"), (2, None), (3, "x<S>")])).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert [found[i].restored_sha256 for i in (1, 2, 3)] == [sha("a\nb\nc"), sha(""), sha("x<S>")]
    assert found[1].output_sha256 == sha(expected(1, "a\nb\nc")[-1])
    assert fill_middle.digest(documents(spark, []).limit(0)).count() == 0


def test_a_text_longer_than_a_slice(spark):
    text = "\n".join(prose(i, 3000, 10**6) for i in range(120))
    assert len(text) > 2 * tx.SLICE_BYTES
    (found,) = fill_middle.restore(fill_middle.transform(documents(spark, [(5, text)]))).collect()
    assert found.output == expected(5, text)[-1] and found.restored == text


def test_outputs_without_their_marks_raise(spark):
    bad = spark.createDataFrame([(1, "psm", "<P>a<S>b")], "doc_id long, form string, output string")
    with pytest.raises(Exception, match="each mark once"):
        fill_middle.restore(bad).collect()
