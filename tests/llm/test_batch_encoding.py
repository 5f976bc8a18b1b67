"""Token ids of a whole batch are those of its texts."""

import pyarrow as pa

from larder.llm.tokens import WordEncoder, vocabulary_path


def test_batch_gives_the_ids_of_its_texts():
    texts = [None, "", " ", "\n \n", "one two one\ttwo", "Été ÑANDÚ, x", "a" * 200 + " a", "1.5 e-mail@x.y 'q' \x1c z", "one two"]
    batch = pa.array(["outside", *texts, "outside"]).slice(1, len(texts))
    one = WordEncoder(vocabulary_path(), bound=4)
    plain = WordEncoder(vocabulary_path())
    for _ in range(2):
        ids, sizes = one.encode_all(batch)
        at = 0
        for text, n in zip(texts, sizes):
            expected = plain.tokenizer.encode(text or "", add_special_tokens=False).ids
            assert ids[at : at + n].tolist() == expected
            assert plain.encode(text or "") == ids[at : at + n].astype("<u4").tobytes()
            at += n
        assert at == len(ids)
    assert [len(x) for x in one.encode_all(pa.array([], "string"))] == [0, 0]
