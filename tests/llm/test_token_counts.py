import public_tokenizers
import sentencepiece
from helpers import documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from barloom.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
_MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)
# Control pieces and the unknown one never match written text; the library needs an unknown piece, so it gets one that no text holds.
_PIECES = [(_MODEL.id_to_piece(i), _MODEL.get_score(i)) for i in range(_MODEL.vocab_size()) if not (_MODEL.is_control(i) or _MODEL.is_unknown(i))]
LIBRARY = Tokenizer(models.Unigram([("\uffff\ufffe\uffff", 0.0), *_PIECES], unk_id=0, byte_fallback=True))
LIBRARY.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)


def expected(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" ▁aether\n</s>")), max_size=60))
def test_any_text_as_the_library(text):
    assert token_counts.counter(PATH).count([text]) == [expected(text)]


def test_written_control_pieces_are_text():
    """The names of control and byte pieces in a text are ordinary characters."""
    texts = ["x</s>", "<s>a", "<unk>", "<<unk>>", "<s></s>"]
    assert token_counts.counter(PATH).count(texts) == [expected(t) for t in texts]
    assert token_counts.counter(PATH).count(["x</s>"]) == [4]
    assert token_counts.counter(PATH).count(["<0x0A>"])[0] > 1


def test_ties_go_to_the_earliest_start():
    pieces = [("▁", -1.0), ("a", -1.0), ("b", -1.0), ("c", -1.0), ("ab", -2.0), ("bc", -2.0), ("abc", -3.0), ("▁a", -2.0)]
    library = Tokenizer(models.Unigram([("<u>", -9.0), *pieces], unk_id=0, byte_fallback=False))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    own = token_counts.UnigramCounter(pieces)
    for text in ["abc", "a", "bca", "abcabc ab c", "cab bc"]:
        assert own.count([text]) == [len(library.encode(text).ids)]


def test_table_with_odd_rows(spark):
    frame = documents(spark).selectExpr("*", "'x' as n_tokens")
    rows = token_counts.count_tokens(frame, PATH).collect()
    assert [r.n_tokens for r in rows] == [expected(r.text) for r in frame.collect()]
