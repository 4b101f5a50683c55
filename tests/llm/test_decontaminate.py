"""Benchmarks of several blocks."""

from triagelake.llm import decontaminate

W = [f"w{i}" for i in range(40)]


def test_blocks_are_searched_on_the_uncut_text(spark, frame):
    items = frame("item_id long, text string", (1, " ".join(W[0:14])), (2, " ".join(W[8:22])), (3, " ".join(["left", *W[30:34], "right", *W[34:38]])))
    docs = frame(
        "doc_id long, text string",
        (1, "before, " + " ".join(W[0:22]) + " - after"), (2, "é " + " ".join(W[0:14]) + " é"),
        (3, "left w30 w31 w32 w33 " + " ".join(W[0:14]) + " right w34 w35 w36 w37"),  # neighbours only by a cut
        (4, None), (5, "clean words"),
    )
    blocks = [b for b in decontaminate.benchmark_blocks(items, "item_id", "text", 20) if b]
    assert len(blocks) == 3
    rows = {}
    for size in (20, decontaminate.BLOCK_BYTES):
        got = decontaminate.find_benchmark(docs, items, cut=True, block_bytes=size).collect()
        rows[size] = {r.doc_id: (r.text, r.bench_words, [(s.start, s.end) for s in r.bench_spans], sorted(r.bench_items)) for r in got}
    assert rows[20] == rows[decontaminate.BLOCK_BYTES]
    assert rows[20][1] == ("before,  - after", 24, [(1, 23)], ["1", "2"])
    assert rows[20][3][0] == "left w30 w31 w32 w33  right w34 w35 w36 w37" and rows[20][4][0] is None and rows[20][5][0] == "clean words"
