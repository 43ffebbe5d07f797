"""What a task of the reader holds at once doesn't grow with the file."""


def test_batches_stay_small(tmp_path):
    from loamline.sources import xlog

    path = tmp_path / "long.txt"
    lines = [f"{k:07d}\t" + "x" * 100 for k in range(80_000)]
    path.write_text("\n".join(lines) + "\n")
    got = [b for r in xlog._ranges(str(path), 0, path.stat().st_size, xlog.SPLIT, False) for b in xlog.read_range(r)]
    assert [x for b in got for x in b.column("line").to_pylist()] == lines
    assert max(b.num_rows for b in got) * 108 <= 2 << 20
