"""Lines of growing files: once each, whole, over restarts."""

import pytest
from pyspark.errors import StreamingQueryException

from wakeline.sources.growing import LinesReader, growing_lines


class Reader:
    """Runs the stream until nothing is new, keeping the checkpoint."""

    def __init__(self, spark, folder, where, **options):
        self.spark, self.where, self.options = spark, str(where), options
        self.out, self.checkpoint = str(folder / "out"), str(folder / "checkpoint")

    def run(self):
        query = (
            growing_lines(self.spark, self.where, **self.options)
            .writeStream.format("parquet")
            .option("checkpointLocation", self.checkpoint)
            .option("path", self.out)
            .start()
        )
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    def lines(self):
        rows = self.spark.read.parquet(self.out).collect()
        return sorted((r.file, r.position, r.raw) for r in rows)


def append(path, text):
    with open(path, "ab") as file:
        file.write(text if isinstance(text, bytes) else text.encode())


def test_lines_arrive_once_over_a_restart(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    append(folder / "a", "old\n")
    append(folder / "_hidden", "no\n")
    reader = Reader(spark, tmp_path, folder, starting="end")
    reader.run()
    append(folder / "a", "one\r\n\n  \ntwo\nhalf")
    reader.run()
    assert reader.lines() == [("a", 4, "one"), ("a", 13, "two")]
    append(folder / "a", " done\nnext")
    append(folder / "b", "new é\n" + "x" * 3_000_000 + "\n")
    reader.run()
    reader.run()
    assert [(f, p, r[:6]) for f, p, r in reader.lines()] == [
        ("a", 4, "one"),
        ("a", 13, "two"),
        ("a", 17, "half d"),
        ("b", 0, "new é"),
        ("b", 7, "xxxxxx"),
    ]
    (folder / "b").unlink()
    append(folder / "a", "\n")
    reader.run()
    assert [x for x in reader.lines() if x[1] == 27] == [("a", 27, "next")]


def test_a_file_of_its_own_read_from_its_start_in_pieces(spark, tmp_path):
    path = tmp_path / "one.jsonl"
    lines = [f"{i} " + "é" * (i % 50) for i in range(3000)]
    append(path, "".join(f"{line}\n" for line in lines))
    reader = Reader(spark, tmp_path, path, starting="start", piece_bytes=997)
    reader.run()
    assert [r for _, _, r in reader.lines()] == [line.rstrip("\r\n") for line in lines]


def test_pieces_of_any_size_share_lines_out(tmp_path):
    path = tmp_path / "f"
    append(path, b"\n\na\n\xff\xfe\nbbbbbbbb\n\nc\nunfinished")
    whole = None
    for size in range(1, 40):
        reader = LinesReader(str(tmp_path), "start", size)
        pieces = reader.partitions(reader.initialOffset(), reader.latestOffset())
        got = [tuple(r.values()) for p in pieces for b in reader.read(p) for r in b.to_pylist()]
        whole = whole or got
        assert got == whole
    assert [r[0] for r in whole] == ["a", "��", "bbbbbbbb", "c"]
    empty = LinesReader(str(tmp_path / "none"), "end", 10)
    assert empty.latestOffset() == {"bytes": {}} == empty.initialOffset()


def test_a_file_that_shrank_is_an_error(spark, tmp_path):
    path = tmp_path / "f"
    append(path, "one\ntwo\n")
    reader = Reader(spark, tmp_path, path, starting="start")
    reader.run()
    path.write_text("one\n")
    with pytest.raises(StreamingQueryException, match="shrank"):
        reader.run()
    running = LinesReader(str(path), "start", 10)
    running.latestOffset()
    path.write_text("o\n")
    with pytest.raises(ValueError, match="shrank"):
        running.latestOffset()
    with pytest.raises(ValueError, match="start or end"):
        LinesReader(str(path), "middle", 10)
