"""The ranks travel as a file, not in the plan: the driver copied them with every step of planning."""

from stratum.llm import bpe


def test_the_plan_does_not_hold_the_ranks(spark, capsys):
    words = spark.createDataFrame([("abc",), ("Ġthe",)], "word string")
    folded = bpe.fold_words(words, bpe.ranks_of(bpe.RANKS))
    folded.explain(True)
    assert len(capsys.readouterr().out) < 100_000                  # over a megabyte as a literal
    ranks = bpe.ranks_of(bpe.RANKS)
    assert {r.word: list(r.ids) for r in folded.collect()}["Ġthe"] == [ranks[b" the"]]


def test_rank_text_survives_the_file(spark):
    odd = {bytes([b]): b for b in range(256)} | {b"\r\n": 256, b"\x01\t": 257, "é".encode(): 258}
    (row,) = bpe.rank_table(spark, odd).collect()
    assert row.ranks == bpe.rank_text(odd)
    found = [line.split("\t") for bucket in row.ranks.split("\x01") for line in bucket.split("\n") if line]
    assert {piece: int(rank) for piece, rank in found} == {bpe.as_symbols(piece): rank for piece, rank in odd.items()}
