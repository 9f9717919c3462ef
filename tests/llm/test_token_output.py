import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from landspark.llm import token_output as o
from landspark.sources.shared import new_path
from tests.llm.helpers import awkward, documents

FILE = public_tokenizers.path("word_bpe_49k.json")
SPEC = open(FILE, encoding="utf-8").read()
WHOLE = Tokenizer.from_str(SPEC)
ENCODER = o.Encoder(SPEC)


def whole(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list(" \t\n\r\x0b\x0c\x1c\x85  .,!?'|<>aAbstrevmlld019éÉİßǅΣσ́ﬁ中한\x01\x00")), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_words_encode_as_the_whole_text(text):
    assert np.frombuffer(ENCODER(text), "<u4").tolist() == whole(text)


@pytest.mark.parametrize("text", ["it's we'll. I'd'", "a.b. c ,d .. e.", "<|endoftext|>", "x<|STARTOFTEXT|> y", "Ends. with mark. ", "A.́ b", "a\x01b \x01 c"])
def test_special_cases(text):
    assert np.frombuffer(ENCODER(text), "<u4").tolist() == whole(text)


def test_generations_of_known_words(monkeypatch):
    monkeypatch.setattr(o, "CACHED_WORDS", 5)
    own = o.Encoder(SPEC)
    for k in range(40):
        text = f"word{k % 7} other{k} and, the. rest"
        assert np.frombuffer(own(text), "<u4").tolist() == whole(text)


def check(spark, df, **settings):
    path = new_path(spark, "tokens")
    got = o.read_tokens(o.write_tokens(df, path, FILE, **settings), path).collect()
    rows = sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at, want = 0, []
    for i, t in rows:
        ids = np.array([*whole(t), 1], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got), key=lambda r: r[1]) == want
    return path.removeprefix("file://"), at


def test_round_trip_of_awkward_rows(spark):
    check(spark, awkward(spark), length=8, batch=3)


def test_files_give_sequences_without_a_copy(spark):
    import glob

    path, total = check(spark, documents(spark, [f"text number {k} " * (k % 40) for k in range(300)]), length=64, batch=4)
    n = 0
    for name in glob.glob(f"{path}/part-*.arrow"):
        with pa.memory_map(name) as source:
            before = pa.total_allocated_bytes()
            file = pa.ipc.open_file(source)
            batch = file.get_batch(0)
            assert pa.types.is_fixed_size_list(batch.schema.field("input_ids").type) and batch.schema.field("input_ids").type.list_size == 64
            ids = batch.column("input_ids")[0].values.to_numpy(zero_copy_only=True)
            assert ids.dtype == np.uint16 and len(ids) == 64 and pa.total_allocated_bytes() == before
            for k in range(file.num_record_batches):
                n += file.get_batch(k).column("attention_mask").flatten().to_numpy(zero_copy_only=False).sum()
    assert n == total and not glob.glob(f"{path}/.part*")


def test_empty_table(spark):
    check(spark, documents(spark, []))


def test_attempts_of_one_task_leave_one_file(tmp_path):
    store = pa.fs.LocalFileSystem()
    for k in range(2):
        (tmp_path / f".part-{k}").write_bytes(b"ids")
        o.place(store, str(tmp_path / f".part-{k}"), str(tmp_path / "part"))
        assert sorted(p.name for p in tmp_path.iterdir()) == ["part"]
    with pytest.raises(FileNotFoundError):
        o.place(store, str(tmp_path / "none"), str(tmp_path / "other"))


def test_many_rows_of_one_id(spark):
    rows = [(5, f"text {k % 97} of id five") for k in range(500)] + [(4, "a"), (6, None), (6, "b")]
    check(spark, documents(spark, rows).repartition(3), length=64, batch=4)
