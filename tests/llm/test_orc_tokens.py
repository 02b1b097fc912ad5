"""Token files: same ids as the tokenizer, order, round trip, pruning."""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.orc
import pytest

from sensorloom.llm import orc_tokens
from sensorloom.llm.queries import tokenizer_file
from tests.llm.conftest import documents, words

ODD = [
    "", None, " ", "  a", "a  b", "a\n b", "a\t\n b <|endoftext|> c", "x\x1c y", " lead", "trail ", "don't  stop\n\n\n go, it's. we'll", "a" * 3000,
    "é" * 500 + " \n\n \n", "a \n b", "\n", "a\r\n  b", "1.2,3 .x ,y a., b,. ...", "naïve café—dash “q” 日本語 한국", "a b  c　 d", "x.\nYes,\nno", "#$% @@ a1b2",
]


def test_ids_are_those_of_whole_texts(rng):
    own = orc_tokens.encoder(tokenizer_file())
    texts = ODD + ["".join(rng.choice(["ab", " ", "é", ".", ",", "\n", "X", "1", "'s", "  ", "\t", "-"]) for _ in range(60)) for _ in range(500)]
    ids, lengths = own.batch(pa.array(texts, pa.string()), 2)
    at = 0
    for text, n in zip(texts, lengths.tolist(), strict=True):
        assert ids[at : at + n].tolist() == [*own.tokenizer.encode(text or "", add_special_tokens=False).ids, 2], repr(text)
        at += n
    assert at == len(ids)
    assert own.batch(pa.array([], pa.string()), 2)[0].size == 0


def test_round_trip(spark, rng, tmp_path):
    rows = [(rng.randrange(10_000), words(rng, rng.randrange(80))) for _ in range(300)]
    rows += [(20_000 + k, t) for k, t in enumerate(ODD)] + [(None, "no id"), rows[0], (rows[1][0], "same id, other text"), (9, words(rng, 30_000))]
    path = f"{tmp_path}/tokens"
    orc_tokens.write_tokens(documents(spark, rows).repartition(3), path, tokenizer_file(), 2)
    encoder = orc_tokens.encoder(tokenizer_file()).tokenizer
    want = {}
    for i, t in rows:
        ids = [*encoder.encode(t or "", add_special_tokens=False).ids, 2]
        want.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = sorted(orc_tokens.token_digests(spark, path).collect(), key=lambda r: r.start)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids) and len(got) == len(rows)
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    # files in the order of their names hold the rows in the order of ids
    files = sorted(p for p in tmp_path.glob("tokens/*.orc"))
    stored = [i for p in files for i in pyarrow.orc.read_table(str(p), columns=["doc_id"])["doc_id"].to_pylist()]
    assert [-1 if i is None else i for i in stored] == ids
    plan = orc_tokens.read_tokens(spark, path).where("doc_id = 9")
    assert "EqualTo(doc_id,9)" in plan._jdf.queryExecution().toString() and plan.count() >= 1


def test_empty_table(spark, tmp_path):
    path = f"{tmp_path}/none"
    orc_tokens.write_tokens(documents(spark, []), path, tokenizer_file(), 2)
    assert orc_tokens.token_digests(spark, path).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5])
def test_slices_cover_the_rows(n):
    column = pa.array(["x" * 10] * n, pa.string())
    assert [r for at, k in orc_tokens.slices(column, 25) for r in range(at, at + k)] == list(range(n))
