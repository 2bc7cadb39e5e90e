"""Binary recordings: files written here by the public formats' rules, read back."""

import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.sources import recordings


def chunk(tag, body):
    return b"\4" + struct.pack("<IH", len(body) + 2, tag) + body


def test_xdf(spark, tmp_path):
    head = b"<info><name>%s</name><channel_count>2</channel_count><nominal_srate>%d</nominal_srate><channel_format>%s</channel_format></info>"
    rng = np.random.default_rng(1)
    jitter = rng.normal(0, 1e-4, 200)
    samples = b"".join(b"\10" + struct.pack("<d", 5 + k / 100 + jitter[k]) + struct.pack("<2f", k, -k) if k % 3 == 0 else b"\0" + struct.pack("<2f", k, -k) for k in range(200))
    data = b"XDF:" + chunk(1, b"<info/>") + chunk(2, struct.pack("<I", 1) + head % (b"left", 100, b"float32")) + chunk(2, struct.pack("<I", 2) + head % (b"marks", 0, b"double64"))
    data += chunk(4, struct.pack("<Idd", 1, 5, 10.0)) + chunk(4, struct.pack("<Idd", 1, 7, 10.2))
    data += chunk(3, struct.pack("<I", 1) + b"\1\xc8" + samples) + chunk(3, struct.pack("<I", 2) + b"\4" + struct.pack("<I", 1) + b"\10" + struct.pack("<3d", 9, 1, 2))
    (tmp_path / "a.xdf").write_bytes(data + chunk(3, b"x" * 50)[:20])  # cut off
    rows = recordings.xdf(spark, str(tmp_path)).orderBy("stream_id", "no").collect()
    assert len(rows) == 201 and rows[-1].stream == "marks" and rows[-1].t == 9 and rows[-1].channels == [1, 2]
    t = np.array([r.t for r in rows[:-1]])
    assert np.abs(t - (15 + np.arange(200) / 100 * 1.1)).max() < 1e-3 and np.ptp(np.diff(t)) < 1e-9
    assert [r.channels for r in rows[:2]] == [[0, 0], [1, -1]]
    one = recordings.armband_rows(recordings.xdf(spark, str(tmp_path), "left")).where("no = 7").first()
    assert (one.board_ts, one.emg1, one.emg2) == (7, -7, None)
    gap = recordings.without_jitter(np.r_[np.arange(50) / 10, 100 + np.arange(50) / 10], 10, gap_samples=20)
    assert gap[50] - gap[49] > 90


def test_event_raw(spark, tmp_path):
    events = [(70, 5, 9, 1), (71, 6, 9, 0), ((1 << 34) + 3, 2047, 0, 1)]
    words = [0x80000000 | (70 >> 6)]
    for t, x, y, p in events:
        if t > 1000:
            words += [0x80000000 | 0xFFFFFFF, 0x80000000]  # the counter starts again
        words.append(p << 28 | (t & 63) << 22 | x << 11 | y)
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "a.raw").write_bytes(b"% evt 2.0\n% end\n" + struct.pack(f"<{len(words)}I", *words))
    rows = recordings.event_raw(spark, str(tmp_path / "two")).orderBy("no").collect()
    assert [(r.t, r.x, r.y, r.p) for r in rows] == events

    e3 = [0x2FFF, 0x8001, 0x6002, 0x0007, 0x2000 | 1 << 11 | 33, 0x3000 | 100, 0x4000 | 0b100000000001, 0x5000 | 0b11, 0x6005, 0x4000 | 1, 0x8FFF, 0x8000, 0x6001, 0x2004]
    (tmp_path / "three").mkdir()
    (tmp_path / "three" / "b.raw").write_bytes(b"% format EVT3;height=720\n% end\n" + struct.pack(f"<{len(e3)}H", *e3) + b"\1")
    rows = recordings.event_raw(spark, str(tmp_path / "three")).orderBy("no").collect()
    at = 4096 + 2
    assert [(r.t, r.x, r.y, r.p) for r in rows] == [(at, 33, 7, 1), (at, 100, 7, 0), (at, 111, 7, 0), (at, 112, 7, 0), (at, 113, 7, 0), (4096 + 5, 120, 7, 0), ((1 << 24) + 1, 4, 7, 0)]


def plain_evt3(words):
    """One word after another, as the format tells it."""
    out, seen, high, wraps, low, y, x, sign = [], False, 0, 0, 0, 0, 0, 0
    for w in words:
        kind, v = w >> 12, w & 4095
        if kind == 8:
            wraps += seen and high - v > 2048
            seen, high = True, v
        elif kind == 6:
            low = v
        elif kind == 0:
            y = v & 2047
        elif kind == 3:
            x, sign = v & 2047, v >> 11
        t = (wraps << 24) + (high << 12) + low
        if kind == 2 and seen:
            out.append((t, v & 2047, y, v >> 11))
        if kind in (4, 5):
            n = 12 if kind == 4 else 8
            out += [(t, x + k, y, sign) for k in range(n) if seen and v >> k & 1]
            x += n
    return out


def plain_evt2(words):
    out, seen, high, wraps = [], False, 0, 0
    for w in words:
        if w >> 28 == 8:
            v = w & 0xFFFFFFF
            wraps += seen and high - v > 1 << 27
            seen, high = True, v
        elif w >> 28 <= 1 and seen:
            out.append((((wraps << 28) + high << 6) + (w >> 22 & 63), w >> 11 & 2047, w & 2047, w >> 28))
    return out


def test_event_files_in_parts(spark, tmp_path):
    """However small the parts, the events are those of one pass; time that begins anew at a border, vectors over it, files without marks."""
    rng = np.random.default_rng(4)
    three = [int(k) << 12 | int(v) for k, v in zip(rng.choice([0, 2, 2, 3, 4, 5, 6, 8, 7, 14], 3000), rng.integers(0, 1024, 3000))]
    for k in np.flatnonzero(np.array(three) >> 12 == 8):
        three[k] = 8 << 12 | int(rng.choice([0, 5, 4000, 4095]))
    two = [int(rng.choice([0, 1, 1, 10])) << 28 | int(rng.integers(0, 1 << 28)) for _ in range(2000)]
    for k in range(150, 2000, 37):
        two[k] = 8 << 28 | int(rng.choice([0, 3, (1 << 28) - 1]))
    (tmp_path / "t3.raw").write_bytes(b"% evt 3.0\n% end\n" + struct.pack("<3000H", *three))
    (tmp_path / "t2.raw").write_bytes(b"% evt 2.0\n% end\n" + struct.pack("<2000I", *two))
    (tmp_path / "no_mark.raw").write_bytes(b"% evt 3.0\n% end\n" + struct.pack("<900H", *[x for x in three if x >> 12 != 8][:900]))
    (tmp_path / "only_head.raw").write_bytes(b"% evt 3.0\n% end\n")
    want = {"t3.raw": plain_evt3(three), "t2.raw": plain_evt2(two)}
    for size in (64, 1000, 1 << 20):
        got = {}
        for r in recordings.event_raw(spark, str(tmp_path), size).orderBy("file", "no").collect():
            got.setdefault(r.file.rpartition("/")[2], []).append((r.no, r.t, r.x, r.y, r.p))
        assert set(got) == set(want)
        for name, rows in got.items():
            assert [r[0] for r in rows] == list(range(len(rows))) and [r[1:] for r in rows] == want[name], (name, size)


def test_images(spark, tmp_path):
    def png(values):
        part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
        rows = b"".join(b"\0" + bytes(x for v in row for x in v) for row in values)
        return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", len(values[0]), len(values), 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")

    (tmp_path / "0.png").write_bytes(png([[(255, 0, 0), (0, 255, 0)], [(0, 0, 255), (9, 9, 9)]]))
    (tmp_path / "1.png").write_bytes(png([[(255, 0, 0), (0, 255, 0)], [(0, 0, 255), (13, 13, 13)]]))
    (tmp_path / "2.png").write_bytes(b"broken")
    frames = recordings.grey_images(spark, str(tmp_path)).withColumn("clip", F.lit(1))
    rows = recordings.frame_differences(frames, ["clip"], "file").orderBy("file").collect()
    assert [r.motion for r in rows] == [None, 1.0]
    assert rows[0].pixels == [76, 150, 29, 9] and (rows[0].height, rows[0].width) == (2, 2)
