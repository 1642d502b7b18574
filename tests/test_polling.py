"""The polling source: parts of files, landed snapshots, restarts."""

import random

import pytest

from delaycast.sources.polling import SnapshotReader, lines_of, read_snapshots


@pytest.mark.parametrize("ending", ["", "\n"])
def test_parts_of_a_file_give_each_line_once(tmp_path, ending):
    chance = random.Random(4)
    for _ in range(60):
        lines = ["x" * chance.randint(0, 9) for _ in range(chance.randint(1, 12))]
        path = tmp_path / "f"
        path.write_text("\n".join(lines) + ending)
        size, step = path.stat().st_size, chance.randint(1, 12)
        found = [line.decode() for at in range(0, size, step) for line in lines_of(str(path), at, min(at + step, size))]
        wanted = path.read_text().split("\n")
        assert [line for line in found if line] == [line for line in wanted if line]


def test_long_lines(tmp_path):
    path = tmp_path / "f"
    path.write_bytes(b"a" * 3_000_000 + b"\n" + b"b" * 2_500_000 + b"\nc")
    parts = [lines_of(str(path), at, min(at + 700_000, 5_500_003)) for at in range(0, 5_500_003, 700_000)]
    assert [(line[:1], len(line)) for part in parts for line in part] == [(b"a", 3_000_000), (b"b", 2_500_000), (b"c", 1)]


def test_only_landed_snapshots_count(tmp_path):
    (tmp_path / "002.json").write_text("x")
    (tmp_path / ".003.json").write_text("x")
    folder = tmp_path / "001"
    folder.mkdir()
    (folder / "part-0").write_text("a\nb\n")
    reader = SnapshotReader(str(tmp_path), 2)
    start = reader.initialOffset()
    assert reader.latestOffset() == {"after": "002.json"}
    assert [p.snapshot for p in reader.partitions(start, {"after": "002.json"})] == ["002.json"]
    (folder / "_SUCCESS").write_text("")
    assert [(p.snapshot, p.start, p.end) for p in reader.partitions(start, {"after": "001"})] == [("001", 0, 2), ("001", 2, 4)]
    assert SnapshotReader(str(tmp_path / "none"), 2).latestOffset() == start


def test_restarts_neither_lose_nor_repeat(spark, tmp_path):
    landed, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    landed.mkdir()

    def run():
        stream = read_snapshots(spark, str(landed), split_bytes=5)
        writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start(out).awaitTermination()

    wanted = []
    for poll in range(4):
        if poll != 1:  # nothing new at one of the polls
            lines = [f"{poll}-{i} é" for i in range(poll + 2)]
            (landed / f"{poll:03d}").write_text("\n".join(lines))
            wanted += [(f"{poll:03d}", line) for line in lines]
        run()
        assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == wanted
