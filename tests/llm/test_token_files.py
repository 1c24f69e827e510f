import tempfile
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyloom.llm.queries import END_ID, QUERIES, token_file_path
from tallyloom.llm.token_files import WordEncoder, read_token_files, write_token_files


def whole(text):
    return Tokenizer.from_file(token_file_path()).encode(text or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t\x0b\x0c\x1c'sét<|endoftext|>9")), max_size=60))
def test_words_encode_as_the_whole_text(text):
    encoder = ENCODER
    assert np.frombuffer(next(encoder([text])), "<u2").tolist() == whole(text)


ENCODER = WordEncoder(token_file_path(), "<u2")


def test_round_trip(docs_of, folder_of, spark, odd):
    folder = folder_of(documents=docs_of(odd, 4))
    rows = QUERIES["op3_token_files"](spark, folder).collect()
    ordered = sorted(odd, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = [whole(t) + [END_ID] for _, t, _ in ordered]
    got = sorted(rows, key=lambda r: r["start"])
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    assert [r["doc_id"] for r in got] == [r[0] for r in ordered]
    assert [r["start"] for r in got] == starts[:-1].tolist()
    assert [r["n_tokens"] for r in got] == [len(x) for x in ids]
    assert [r["ids_crc32"] for r in got] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]


def test_empty_table(docs_of):
    folder = tempfile.mkdtemp(prefix="tokens-")
    manifest = write_token_files(docs_of([]), folder, token_file_path(), END_ID)
    assert read_token_files(manifest, folder).count() == 0
