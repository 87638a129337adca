"""Piece codec against the library's own unigram search over the same pieces, and round trips."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from ledgerfold.llm import piece_codec as pc
from ledgerfold.llm.piece_codec import codec
from tests.conftest import SF

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", None, "a", "Hello world, this is it.", "  two  spaces ", "tab\tand\nline", "日本語 🙂 x", "<s> </s> <unk>", "x" * 500, "word " * 4000,
         "a▁b", "\x00\x01", "naïve ﬁ \xa0 end", "<0x41>"]


@pytest.fixture(scope="module")
def unigram_path(tmp_path_factory):
    """The same pieces in a file that asks the library for the best segmentation. Scores of -1e9
    would drown the others in the library's single precision."""
    proto = pb.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = pb.TrainerSpec.ModelType.UNIGRAM
    for piece in proto.pieces:
        piece.score = max(piece.score, -40_000.0)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


def corpus(spark):
    rng = random.Random(3)
    made = ["".join(rng.choice("etaoin shrdlu.,é🙂") for _ in range(rng.randrange(1, 80))) for _ in range(200)]
    return [t or "" for t in TEXTS] + made + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]


def total(codec, ids):
    return sum(codec.scores_of[codec.pieces[i]][0] if codec.pieces[i] in codec.scores_of else 0 for i in ids)


def test_segmentation_is_the_library_s(spark, unigram_path):
    codec, library = pc.PieceCodec(unigram_path), sentencepiece.SentencePieceProcessor(model_file=unigram_path)
    texts = corpus(spark)
    for text, ids in zip(texts, codec.encode(texts)):
        want = library.encode(text)
        assert ids.tolist() == want or total(codec, ids) == total(codec, want), text[:80]


def test_together_and_alone_agree(spark):
    codec = pc.PieceCodec(PATH)
    words = sorted({w for t in corpus(spark) for w in pc.WORD.findall(pc.MARK + t.replace(" ", pc.MARK)) if len(w) <= pc.LONG})[:4000]
    for length in sorted({len(w) for w in words}):
        group = [w for w in words if len(w) == length]
        assert codec.solve(group) == [codec.solve_alone(w) for w in group]


def test_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", "y"), (2, "a", "z")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    codec = pc.PieceCodec(PATH)
    got = pc.decode(pc.encode(frame, PATH), PATH).collect()
    assert len(got) == len(rows)
    texts = dict((i, t or "") for i, t, _ in rows)
    for r in got:
        assert r.ids == codec.encode([texts[r.doc_id]])[0].tolist()
        assert r.decoded == texts[r.doc_id].replace(pc.MARK, " ")
    trip = pc.round_trip(frame, PATH).collect()
    assert len(trip) == len(rows) and all(r.same for r in trip)
    assert pc.round_trip(frame.limit(0), PATH).count() == 0
    assert codec.decode([1, 2]) == "" and codec.decode([codec.byte_ids[0xFF]]) == "�"


def test_lists_of_ids_are_decoded_as_single_ones():
    found = codec(public_tokenizers.path("piece_bpe_32k.model"))
    ids = [i.tolist() for i in found.encode(["", " two  words", "a\u0001\U0001F9FF b\n", "x" * 70])] + [None, [found.byte_ids[200].item()]]
    lists = pa.array([[5], *ids, None], pa.list_(pa.int32())).slice(1, len(ids))
    assert found.decode_lists(lists) == [found.decode(i or []) for i in ids]
    assert found.decode_lists(lists.slice(0, 0)) == []
