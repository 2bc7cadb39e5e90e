"""Writes small HDF5 files by the format's public rules, for the reader's tests."""

import struct
import zlib

import numpy as np

NONE = (1 << 64) - 1


class Writer:
    def __init__(self):
        self.b = bytearray(96)

    def put(self, data: bytes) -> int:
        self.b += b"\0" * (-len(self.b) % 8)
        at = len(self.b)
        self.b += data
        return at

    def header(self, messages, split=False) -> int:
        """An object header; split puts all but the first message into a continuation."""
        body = [struct.pack("<HHB3x", n, -(-len(d) // 8) * 8, 0) + d + b"\0" * (-len(d) % 8) for n, d in messages]
        if split:
            rest = b"".join(body[1:])
            at = self.put(rest)
            body = [body[0], struct.pack("<HHB3x", 16, 16, 0) + struct.pack("<QQ", at, len(rest))]
        data = b"".join(body)
        return self.put(struct.pack("<BxHII4x", 1, len(messages) + split, 1, len(data)) + data)

    def group(self, members: dict[str, int]) -> int:
        names, offsets = bytearray(8), {}
        for n in sorted(members):
            offsets[n] = len(names)
            names += n.encode() + b"\0" * (8 - len(n.encode()) % 8)
        data = self.put(bytes(names))
        heap = self.put(b"HEAP" + struct.pack("<B3xQQQ", 0, len(names), NONE, data))
        nodes, ordered = [], sorted(members)
        for k in range(0, len(ordered), 8):
            part = ordered[k : k + 8]
            nodes.append(self.put(b"SNOD" + struct.pack("<BxH", 1, len(part)) + b"".join(struct.pack("<QQII16x", offsets[n], members[n], 0, 0) for n in part)))
        tree = self.put(b"TREE" + struct.pack("<BBHQQ", 0, 0, len(nodes), NONE, NONE) + b"".join(struct.pack("<QQ", 0, n) for n in nodes) + struct.pack("<Q", 0))
        return self.header([(17, struct.pack("<QQ", tree, heap))])

    def kind(self, dtype) -> bytes:
        if dtype == "vlen f8":
            return struct.pack("<BBBBI", 0x19, 0, 0, 0, 16) + self.kind(np.dtype("<f8"))
        if dtype == "text":
            return struct.pack("<BBBBI", 0x19, 1, 0, 0, 16) + self.kind(np.dtype("S1"))
        if isinstance(dtype, list):
            out, at = b"", 0
            for n, k in dtype:
                name = n.encode() + b"\0"
                out += name + b"\0" * (-len(name) % 8) + struct.pack("<IB3xI4x16x", at, 0, 0) + self.kind(k)
                at += 16 if isinstance(k, str) and k in ("vlen f8", "text") else np.dtype(k).itemsize
            return struct.pack("<BBBBI", 0x16, len(dtype), 0, 0, at) + out
        dtype = np.dtype(dtype)
        big = dtype.str[0] == ">"
        if dtype.kind == "S":
            return struct.pack("<BBBBI", 0x13, 0, 0, 0, dtype.itemsize)
        if dtype.kind == "f":
            return struct.pack("<BBBBI", 0x11, 0x20 | big, 31, 0, dtype.itemsize) + b"\0" * 12
        return struct.pack("<BBBBI", 0x10, big | (8 if dtype.kind == "i" else 0), 0, 0, dtype.itemsize) + struct.pack("<HH", 0, 8 * dtype.itemsize)

    def heap(self, items: list[bytes]) -> list[tuple[int, int]]:
        body = b"".join(struct.pack("<HH4xQ", k + 1, 1, len(d)) + d + b"\0" * (-len(d) % 8) for k, d in enumerate(items)) + struct.pack("<HH4xQ", 0, 0, 0)
        at = self.put(b"GCOL" + struct.pack("<B3xQ", 1, 16 + len(body)) + body)
        return [(at, k + 1) for k in range(len(items))]

    def dataset(self, shape, kind, raw: np.ndarray, chunk=None, deflate=False, shuffle=False, checksum=False, fanout=4, skip=(), split=False) -> int:
        space = struct.pack("<BBB5x", 1, len(shape), 0) + struct.pack(f"<{len(shape)}Q", *shape)
        messages = [(1, space), (3, self.kind(kind))]
        if chunk is None:
            at = self.put(raw.tobytes())
            messages.append((8, struct.pack("<BBQQ", 3, 1, at, raw.nbytes)))
        else:
            entries, size = [], raw.dtype.itemsize
            for idx in np.ndindex(*[-(-n // c) for n, c in zip(shape, chunk)]):
                off = [i * c for i, c in zip(idx, chunk)]
                if tuple(off) in skip:
                    continue
                block = np.zeros(chunk, raw.dtype)
                part = raw[tuple(slice(o, o + c) for o, c in zip(off, chunk))]
                block[tuple(slice(0, n) for n in part.shape)] = part
                data = block.tobytes()
                if shuffle:
                    data = np.frombuffer(data, np.uint8).reshape(-1, size).T.tobytes()
                if deflate:
                    data = zlib.compress(data)
                if checksum:
                    data += b"\1\2\3\4"
                entries.append((off, self.put(data), len(data)))
            key = lambda off, n: struct.pack("<II", n, 0) + struct.pack(f"<{len(shape) + 1}Q", *off, 0)
            end, level = [shape[0] + chunk[0], *[0] * (len(shape) - 1)], 0
            nodes = entries
            while True:
                up = []
                for k in range(0, max(1, len(nodes)), fanout):
                    part = nodes[k : k + fanout]
                    after = nodes[k + fanout][0] if k + fanout < len(nodes) else end
                    at = self.put(b"TREE" + struct.pack("<BBHQQ", 1, level, len(part), NONE, NONE) + b"".join(key(o, n) + struct.pack("<Q", a) for o, a, n in part) + key(after, 0))
                    up.append((part[0][0] if part else end, at, 0))
                nodes, level = up, level + 1
                if len(nodes) == 1:
                    break
            messages.append((8, struct.pack("<BBBQ", 3, 2, len(shape) + 1, nodes[0][1]) + struct.pack(f"<{len(shape) + 1}I", *chunk, size)))
            filters = [f for f, on in ((struct.pack("<HHHHI4x", 2, 0, 0, 1, size), shuffle), (struct.pack("<HHHHI4x", 1, 0, 0, 1, 6), deflate), (struct.pack("<HHHH", 3, 0, 0, 0), checksum)) if on]
            if filters:
                messages.append((11, struct.pack("<BB6x", 1, len(filters)) + b"".join(filters)))
        return self.header(messages, split)

    def save(self, path, root: int) -> str:
        self.b[:96] = b"\x89HDF\r\n\x1a\n" + struct.pack("<BBBxBBBxHHI", 0, 0, 0, 0, 8, 8, 4, 16, 0) + struct.pack("<QQQQ", 0, NONE, len(self.b), NONE) + struct.pack("<QQII16x", 0, root, 0, 0)
        path.write_bytes(bytes(self.b))
        return str(path)
