"""FLAC media columns: encode payloads, decode Rice residuals and linear predictors, check every frame's
sums, and give PCM blocks with seekable sample offsets.

The decoder takes one to eight channels (left and side, right and side, middle and side too), constant,
verbatim, fixed and linear-predictor subframes with wasted bits, Rice partitions with 4 or 5 bits of
parameter and their escape codes, and samples of 4 to 32 bits; a bad magic, header sum (CRC-8), frame
sum (CRC-16), frame number, length or MD5 raises ValueError. Frames are independent, so many frames (of
one or more streams) are decoded side by side: step t handles sample t of each. The stream's seek table
tells where some frames begin; the frames after each point are found one after the other, all points at
a time, and a reader of some samples begins at the last point before them. Written streams are mono.

The encoder writes blocks of `BLOCK` samples with a seek point for each, and picks for every
block the cheapest of the fixed predictors of order 0 to 2, a linear predictor, a constant or the
plain samples.

Payloads are the UTF-8 bytes of a text, followed by bytes 0 up to a positive multiple of 64; a null
text is empty. Sample values are byte - 128. Each row is handled for itself, so repeated rows
give repeated results.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import as_bytes, portions

BLOCK, LPC_ORDER, PRECISION, LPC = 512, 2, 10, -1
LANES = 4096
#: Coefficients of the fixed predictors by order.
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))


def _crc_table(poly: int, bits: int) -> np.ndarray:
    out, top, mask = [], 1 << (bits - 1), (1 << bits) - 1
    for value in range(256):
        crc = value << (bits - 8)
        for _ in range(8):
            crc = ((crc << 1) ^ poly if crc & top else crc << 1) & mask
        out.append(crc)
    return np.array(out, np.uint16)


CRC8, CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)
#: Leading zeros of a 16-bit number.
ZEROS = np.array([16 - int(x).bit_length() for x in range(1 << 16)], np.int64)


def crc_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, wide: bool) -> np.ndarray:
    """CRC-16 (or CRC-8) of each data[start : start + length], a byte of all at a time."""
    by_length = np.argsort(-lengths, kind="stable")
    at, n = starts[by_length], lengths[by_length]
    crc = np.zeros(len(at), np.uint16)
    reach = np.searchsorted(-n, -np.arange(int(n[0]) if len(n) else 0), side="left")
    for step, k in enumerate(reach.tolist()):
        byte = data[at[:k] + step]
        crc[:k] = (crc[:k] << 8) ^ CRC16[(crc[:k] >> 8) ^ byte] if wide else CRC8[crc[:k] ^ byte]
    out = np.empty_like(crc)
    out[by_length] = crc
    return out


def _pack(values: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Big-endian bits of values (of `widths` bits, 0 to 57 each, and nothing above), one after the other, as bytes."""
    ends = np.cumsum(widths)
    at = ends - widths
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total // 64 + 2, np.uint64)
    if len(at):
        word, room = at >> 6, 64 - (at & 63) - widths
        over = np.flatnonzero(room < 0)
        here = values << np.clip(room, 0, 63).view(np.uint64)
        here[over] = values[over] >> (-room[over]).view(np.uint64)
        starts = np.flatnonzero(word[1:] != word[:-1]) + 1
        starts = np.concatenate([[0], starts])
        words[word[starts]] = np.bitwise_or.reduceat(here, starts)
        words[word[over] + 1] |= values[over] << (64 + room[over]).view(np.uint64)
    return words.byteswap().view(np.uint8)[: total // 8]


def _utf8_number(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frame numbers below 2**31 in the UTF-8 manner: values and their widths in bits."""
    value, width = n.copy(), np.full(len(n), 8)
    for size, bound, lead in ((2, 7, 0xC0), (3, 11, 0xE0), (4, 16, 0xF0), (5, 21, 0xF8), (6, 26, 0xFC)):
        v = lead | (n >> (6 * (size - 1)))
        for j in range(size - 2, -1, -1):
            v = (v << 8) | 0x80 | ((n >> (6 * j)) & 63)
        wide = (n >> bound) > 0
        value, width = np.where(wide, v, value), np.where(wide, 8 * size, width)
    return value, width


def _predictors(x: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Quantised linear predictors of each row by Levinson's recursion: coefficients and shifts."""
    f = x.astype(np.float32)
    r = np.stack([np.einsum("ij,ij->i", f[:, k:], f[:, : f.shape[1] - k]) for k in range(order + 1)], 1).astype(np.float64)
    a, err = np.zeros((len(x), order)), np.maximum(r[:, 0], 1e-9)
    for i in range(order):
        k = (r[:, i + 1] - (a[:, :i] * r[:, i:0:-1]).sum(1)) / err
        a[:, :i] -= k[:, None] * a[:, :i][:, ::-1]
        a[:, i] = k
        err = np.maximum(err * (1 - k * k), 1e-9)
    shift = np.clip(PRECISION - 1 - np.ceil(np.log2(np.maximum(np.abs(a).max(1), 1e-6))), 0, 15).astype(np.int64)
    top = 1 << (PRECISION - 1)
    return np.clip(np.rint(a * (1 << shift)[:, None]), -top, top - 1).astype(np.int32), shift.astype(np.int32)


def encode_blocks(x: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frames of equally long blocks of 8-bit samples (one row each): all their bytes, and each one's length."""
    lanes, n = x.shape
    candidates = {0: x}
    for o in range(1, min(2, n - 1) + 1):
        candidates[o] = np.concatenate([candidates[o - 1][:, :1], np.diff(candidates[o - 1], axis=1)], 1)
    coefficients, shift = np.zeros((lanes, LPC_ORDER), np.int32), np.zeros(lanes, np.int32)
    linear = n > 8 * LPC_ORDER
    if linear:
        coefficients, shift = _predictors(x, LPC_ORDER)
        guess = coefficients[:, :1] * x[:, LPC_ORDER - 1 : n - 1]
        for j in range(1, LPC_ORDER):
            guess += coefficients[:, j : j + 1] * x[:, LPC_ORDER - 1 - j : n - 1 - j]
        guess >>= shift[:, None]
        candidates[LPC] = np.concatenate([x[:, :LPC_ORDER], x[:, LPC_ORDER:] - guess], 1)
    kinds = np.array(list(candidates))
    warm_of = np.where(kinds == LPC, LPC_ORDER, kinds)
    sums = np.stack([np.abs(c[:, o:]).sum(1, dtype=np.int32) + (40 if o else 0) for c, o in zip(candidates.values(), warm_of.tolist(), strict=True)], 1)
    choice = sums.argmin(1)
    residual = x.copy()
    for i, c in enumerate(candidates.values()):
        if i:
            residual[choice == i] = c[choice == i]
    order, is_lpc = warm_of[choice].astype(np.int32), kinds[choice] == LPC
    u = (residual << 1) ^ (residual >> 31)
    for j in range(LPC_ORDER):
        u[order > j, min(j, n - 1)] = 0
    mean = u.sum(1, dtype=np.int32) / np.maximum(1, n - order)
    k = np.floor(np.log2(np.maximum(mean, 1))).astype(np.int32)
    k = np.maximum(k, np.ceil(np.log2(u.max(1) + 1)).astype(np.int32) - 5)
    widths = (u >> k[:, None]) + (1 + k)[:, None]
    for j in range(LPC_ORDER):
        widths[order > j, min(j, n - 1)] = 0
    constant = (x == x[:, :1]).all(1)
    plain = ~constant & ((widths.sum(1) + 8 * order > 8 * n) | (k > 14))
    coded = ~constant & ~plain
    values = (u & ((1 << k) - 1)[:, None]) | (1 << k)[:, None]
    values[widths == 0] = 0
    values[plain], widths[plain] = x[plain] & 255, 8
    values[constant], widths[constant] = 0, 0

    number, number_width = _utf8_number(numbers)
    lead = [(np.full(lanes, 0xFFF8), 16), (np.full(lanes, 0x7402), 16), (number, number_width), (np.full(lanes, n - 1), 16)]
    head = np.stack([v for v, _ in lead], 1).astype(np.uint64), np.stack([np.broadcast_to(w, lanes) for _, w in lead], 1).astype(np.int64)
    head_bytes, head_sizes = _pack(head[0].ravel(), head[1].ravel()), head[1].sum(1) // 8
    sums8 = crc_of(head_bytes, np.cumsum(head_sizes) - head_sizes, head_sizes, False)
    kind = np.where(constant, 0, np.where(plain, 1, np.where(is_lpc, 32 + LPC_ORDER - 1, 8 + order)))
    columns = [*lead, (sums8.astype(np.int64), 8), (kind << 1, 8)]
    for j in range(LPC_ORDER):
        warm = (coded & (order > j)) | (constant if j == 0 else False)
        columns.append((x[:, min(j, n - 1)] & 255, np.where(warm, 8, 0)))
    lpc = coded & is_lpc
    columns += [(np.full(lanes, PRECISION - 1), np.where(lpc, 4, 0)), (shift, np.where(lpc, 5, 0))]
    columns += [(coefficients[:, j] & ((1 << PRECISION) - 1), np.where(lpc, PRECISION, 0)) for j in range(LPC_ORDER)]
    columns.append((np.minimum(k, 14), np.where(coded, 10, 0)))
    extra_v = np.stack([np.broadcast_to(v, lanes) for v, _ in columns], 1)
    extra_w = np.stack([np.broadcast_to(w, lanes) for _, w in columns], 1)
    pad = -(extra_w.sum(1) + widths.sum(1)) % 8
    zero = np.zeros((lanes, 2), np.int64)
    all_v = np.concatenate([np.where(extra_w > 0, extra_v, 0), values, zero], 1, dtype=np.int64).view(np.uint64)
    all_w = np.concatenate([extra_w, widths, pad[:, None], np.full((lanes, 1), 16)], 1, dtype=np.int64)
    data, sizes = _pack(all_v.ravel(), all_w.ravel()).copy(), all_w.sum(1) // 8
    ends = np.cumsum(sizes)
    sums16 = crc_of(data, ends - sizes, sizes - 2, True)
    data[ends - 2], data[ends - 1] = sums16 >> 8, sums16 & 255
    return data, sizes


def encode(payloads: list[bytes], rate: int = 8000) -> list[bytes]:
    """A FLAC stream of 8-bit mono samples for each payload, whose length must be at least 1."""
    jobs: dict[int, list[tuple[int, int]]] = {}
    for p, payload in enumerate(payloads):
        for number in range(-(-len(payload) // BLOCK)):
            jobs.setdefault(min(BLOCK, len(payload) - number * BLOCK), []).append((p, number))
    frames: list[dict[int, bytes]] = [{} for _ in payloads]
    for n, all_lanes in jobs.items():
        for at in range(0, len(all_lanes), LANES):
            lanes = all_lanes[at : at + LANES]
            raw = b"".join(payloads[p][i * BLOCK : i * BLOCK + n] for p, i in lanes)
            x = np.frombuffer(raw, np.uint8).reshape(-1, n).astype(np.int32) - 128
            data, sizes = encode_blocks(x, np.array([i for _, i in lanes], np.int64))
            whole, ends = data.tobytes(), np.cumsum(sizes).tolist()
            for (p, i), end, size in zip(lanes, ends, sizes.tolist(), strict=True):
                frames[p][i] = whole[end - size : end]
    out = []
    for payload, own in zip(payloads, frames, strict=True):
        parts = [own[i] for i in range(len(own))]
        sizes, at, points = [len(f) for f in parts], 0, []
        for i, size in enumerate(sizes):
            points.append(struct.pack(">QQH", i * BLOCK, at, min(BLOCK, len(payload) - i * BLOCK)))
            at += size
        signed = bytes(payload).translate(_FLIP)
        info = struct.pack(">HH", BLOCK, BLOCK) + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big")
        info += (rate << 44 | 0 << 41 | 7 << 36 | len(payload)).to_bytes(8, "big") + hashlib.md5(signed).digest()
        table = b"".join(points)
        out.append(b"".join([b"fLaC", b"\0", len(info).to_bytes(3, "big"), info, b"\x83", len(table).to_bytes(3, "big"), table, *parts]))
    return out


#: byte -> byte - 128 as a signed byte.
_FLIP = bytes((b - 128) & 255 for b in range(256))


class _Bits:
    """Random access to the bits of a buffer, for many places at once."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate([data, np.zeros(16, np.uint8)]).astype(np.uint64)
        self.windows = np.zeros(len(data) + 9, np.uint64)
        for j in range(8):
            self.windows |= padded[j : j + len(self.windows)] << np.uint64(56 - 8 * j)

    def ahead(self, at: np.ndarray) -> np.ndarray:
        """The next 57 bits or more, at the top of a 64-bit number."""
        return self.windows.take(at >> 3) << (at & 7).view(np.uint64)

    def read(self, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """n bits (0 to 57) as a number."""
        n = np.broadcast_to(np.asarray(n, np.uint64), at.shape)
        return np.where(n > 0, self.ahead(at) >> np.minimum(np.uint64(64) - n, np.uint64(63)), 0).astype(np.int64)

    def signed(self, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        v, n = self.read(at, n), np.broadcast_to(np.asarray(n, np.int64), at.shape)
        return np.where((n > 0) & (v >> np.maximum(n - 1, 0) & 1 == 1), v - (np.int64(1) << n), v)


def _coded(bits: _Bits, pos: np.ndarray, order: np.ndarray, count: np.ndarray, depth: np.ndarray, lpc: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Samples of subframes with a predictor, from their warm-up on, and the bit after each."""
    fail = lambda what: ValueError(f"not a readable FLAC frame: {what}")
    # The longest blocks come first, so that the lanes still at work are always the first ones.
    turn = np.argsort(-count, kind="stable")
    pos, order, count, depth, lpc = (v[turn] for v in (pos, order, count, depth, lpc))
    fixed = ~lpc
    lanes, steps, most = len(turn), int(count[0]) if len(count) else 0, int(order.max()) if len(order) else 0
    out = np.zeros((steps, lanes), np.int64)
    for j in range(most):
        here = order > j
        out[j] = np.where(here, bits.signed(pos, depth), 0)
        pos = pos + np.where(here, depth, 0)
    coefficients, shift = np.zeros((max(1, most), lanes), np.int64), np.zeros(lanes, np.int64)
    for o in range(1, 5):
        for j, c in enumerate(FIXED[o]):
            if j < len(coefficients):
                coefficients[j] = np.where(fixed & (order == o), c, coefficients[j])
    if lpc.any():
        precision = np.where(lpc, bits.read(pos, 4) + 1, 0)
        shift = np.where(lpc, bits.signed(pos + 4, 5), 0)
        if (precision == 16).any() or (shift < 0).any():
            raise fail("a predictor out of range")
        pos = pos + np.where(lpc, 9, 0)
        for j in range(most):
            here = lpc & (order > j)
            coefficients[j] = np.where(here, bits.signed(pos, np.where(here, precision, 0)), coefficients[j])
            pos = pos + np.where(here, precision, 0)
    method, splits = bits.read(pos, 2), bits.read(pos + 2, 4)
    if (method > 1).any() or (count % (1 << splits)).any() or ((count >> splits) < order).any():
        raise fail("a broken partition")
    width = np.where(method == 1, 5, 4)
    pos = pos + 6
    length = np.maximum(1, count >> splits)
    k, raw = np.zeros(lanes, np.int64), np.full(lanes, -1, np.int64)
    begins = np.zeros(lanes, np.int64)  # the step at which the next partition's parameter is due
    usual, any_raw = not splits.any(), False
    active = np.searchsorted(-count, -np.arange(steps), side="left").tolist()
    for t, n in enumerate(active):
        if t > most and usual and not any_raw:
            if t == most + 1:  # nothing changes from here on
                reach, back_by, low_bits = k + 1, 63 - k, (np.int64(1) << k) - 1
            p, kk = pos[:n], k[:n]
            ahead = bits.ahead(p)
            q = ZEROS.take((ahead >> np.uint64(48)).view(np.int64))
            if n and int(q.max()) < 16:
                low = (ahead >> (back_by[:n] - q).view(np.uint64)).view(np.int64) & low_bits[:n]
                out[t, :n] = q << kk | low
                p += q
                p += reach[:n]
                continue
        due = begins[:n] == t
        if t == 0 or not usual:
            if due.any():
                w = np.where(due, width[:n], 0)
                got = bits.read(pos[:n], w)
                pos[:n] += w
                escape = due & (got == (1 << w) - 1)
                k[:n] = np.where(due, got, k[:n])
                raw[:n] = np.where(due, -1, raw[:n])
                if escape.any():
                    any_raw = True
                    raw[:n] = np.where(escape, bits.read(pos[:n], np.where(escape, 5, 0)), raw[:n])
                    pos[:n] += np.where(escape, 5, 0)
                begins[:n] = np.where(due, t + length[:n], begins[:n])
        p, kk = pos[:n], k[:n]
        ahead = bits.ahead(p)
        q = ZEROS[(ahead >> np.uint64(48)).astype(np.int64)]
        long = np.flatnonzero(q == 16)
        rice = (raw[:n] < 0) & (order[:n] <= t)
        for_long = long[rice[long]]
        if len(for_long):
            here = for_long
            while len(here):
                more = ZEROS[(bits.ahead(p[here] + q[here]) >> np.uint64(48)).astype(np.int64)]
                q[here] += more
                here = here[(more == 16) & (p[here] + q[here] < limit)]
            low = bits.read(p + q + 1, kk)
        else:
            low = ((ahead << (q + 1).astype(np.uint64)) >> (63 - kk).astype(np.uint64) >> np.uint64(1)).astype(np.int64)
        u = q << kk | low
        used = q + 1 + kk
        if any_raw or t < most or not usual:
            plain_bits = (raw[:n] >= 0) & (order[:n] <= t)
            used = np.where(rice, used, 0)
            u = np.where(rice, u, 0)
            if plain_bits.any():
                r = bits.signed(p, np.where(plain_bits, raw[:n], 0))
                u = np.where(plain_bits, (r << 1) ^ (r >> 63), u)
                used = np.where(plain_bits, raw[:n], used)
            if t < most:
                u = np.where(order[:n] > t, (out[t, :n] << 1) ^ (out[t, :n] >> 63), u)
        out[t, :n] = u
        pos[:n] += used
    out = (out >> 1) ^ -(out & 1)
    for o in range(1, most + 1):
        for which in (fixed & (order == o), lpc & (order == o)):
            own = np.flatnonzero(which)
            if not len(own):
                continue
            x = out[:, own]
            if o <= 2 and fixed[own[0]]:
                # Differences are undone by sums; the warm-up samples first become differences too.
                if o == 2:
                    x[1] -= x[0]
                    x[1:] = np.cumsum(x[1:], axis=0)
                x = np.cumsum(x, axis=0)
            else:
                c, by = coefficients[:o, own], shift[own]
                for t in range(o, steps):
                    x[t] += (c * x[t - o : t][::-1]).sum(0) >> by
            out[:, own] = x
    back = np.empty(lanes, np.int64)
    back[turn] = np.arange(lanes)
    return out.T[back], pos[back]


def _subframes(bits: _Bits, pos: np.ndarray, count: np.ndarray, depth: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Samples (lanes by steps, zero beyond the block) of the subframes at the given bits, and the bit after each."""
    fail = lambda what: ValueError(f"not a readable FLAC frame: {what}")
    kind, wasted = bits.read(pos + 1, 6), bits.read(pos + 7, 1)
    if bits.read(pos, 1).any():
        raise fail("a broken subframe")
    pos = pos + 8
    zeros = np.where(wasted == 1, ZEROS.take((bits.ahead(pos) >> np.uint64(48)).view(np.int64)), -1)
    pos, depth = pos + zeros + 1, depth - zeros - 1
    if (depth < 1).any():
        raise fail("more wasted bits than a sample has")
    fixed, lpc = (kind >= 8) & (kind <= 12), kind >= 32
    if not (fixed | lpc | (kind < 2)).all():
        raise fail("an unknown kind of subframe")
    order = np.select([fixed, lpc], [kind - 8, kind - 31], 0)
    if (order > count).any():
        raise fail("a predictor longer than its block")
    samples = np.zeros((len(pos), int(count.max()) if len(pos) else 0), np.int64)
    constant, plain, coded = (np.flatnonzero(x) for x in (kind == 0, kind == 1, fixed | lpc))
    samples[constant] = bits.signed(pos[constant], depth[constant])[:, None]
    pos[constant] += depth[constant]
    if len(plain):
        place = np.arange(samples.shape[1])
        bit = pos[plain, None] + place * depth[plain, None]
        inside = place < count[plain, None]
        wide = np.broadcast_to(depth[plain, None], bit.shape)
        samples[plain] = np.where(inside, bits.signed(np.where(inside, np.minimum(bit, limit), 0), wide), 0)
        pos[plain] += count[plain] * depth[plain]
    if len(coded):
        rows, ends = _coded(bits, *(v[coded] for v in (pos, order, count, depth, lpc)), limit)
        samples[coded, : rows.shape[1]], pos[coded] = rows, ends
    samples[np.arange(samples.shape[1]) >= count[:, None]] = 0
    if (pos > limit).any():
        raise fail("it ends too early")
    return samples << (zeros + 1)[:, None], pos


def decode_frames(data: np.ndarray, starts: np.ndarray, depth: np.ndarray, channels: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Decode the frames at the given bytes; depth: bits a sample by lane, used where a frame doesn't say.

    Returns each lane's samples (lanes by steps by channels, zero beyond the block), block size, end in bytes,
    number and whether that is one of samples (blocks of variable size) instead of frames.
    """
    bits = _Bits(data)
    fail = lambda what: ValueError(f"not a readable FLAC frame: {what}")
    at = starts.astype(np.int64) * 8
    if (starts + 6 > len(data)).any() or (bits.read(at, 15) != 0x7FFC).any():
        raise fail("no sync code")
    variable = bits.read(at + 15, 1) == 1
    size_code, rate_code = bits.read(at + 16, 4), bits.read(at + 20, 4)
    kind, size, reserved = bits.read(at + 24, 4), bits.read(at + 28, 3), bits.read(at + 31, 1)
    if reserved.any() or (np.where(kind < 8, kind + 1, np.where(kind < 11, 2, 0)) != channels).any():
        raise fail("another number of channels")
    depth = np.select([size == k for k in (1, 2, 4, 5, 6, 7, 0)], [8, 12, 16, 20, 24, 32, depth], 0)
    if (depth == 0).any() or (rate_code == 15).any() or (size_code == 0).any():
        raise fail("an unknown code")
    first = bits.read(at + 32, 8)
    ones = np.select([first < x for x in (0x80, 0xC0, 0xE0, 0xF0, 0xF8, 0xFC, 0xFE, 0xFF)], [1, 0, 2, 3, 4, 5, 6, 7], 0)
    if (ones == 0).any():
        raise fail("a broken frame number")
    number = np.where(ones == 1, first, first & ((1 << np.maximum(0, 7 - ones)) - 1))
    for j in range(1, int(ones.max()) if len(ones) else 0):
        more = bits.read(at + 32 + 8 * j, 8)
        number = np.where(j < ones, number << 6 | (more & 63), number)
    pos = at + 32 + 8 * ones
    own = np.select([size_code == 6, size_code == 7], [bits.read(pos, 8), bits.read(pos, 16)], 0) + 1
    count = np.select([size_code == 1, size_code < 6, size_code < 8], [192, 576 << np.maximum(size_code - 2, 0), own], 256 << np.maximum(size_code - 8, 0))
    pos = pos + np.select([size_code == 6, size_code == 7], [8, 16], 0)
    pos = pos + np.select([rate_code == 12, (rate_code == 13) | (rate_code == 14)], [8, 16], 0)
    if (pos // 8 >= len(data)).any() or (crc_of(data, starts, (pos - at) // 8, False) != bits.read(pos, 8)).any():
        raise fail("a wrong header sum")
    pos = pos + 8

    samples = np.zeros((len(at), int(count.max()) if len(at) else 0, channels), np.int64)
    for c in range(channels):
        # The side channel, the difference of both, has one bit more.
        side = (kind == 9) if c == 0 else (kind == 8) | (kind == 10)
        samples[:, :, c], pos = _subframes(bits, pos, count, depth + side, 8 * len(data))
    if channels == 2:
        a, b = samples[:, :, 0], samples[:, :, 1]
        for code in (8, 9, 10):
            which = np.flatnonzero(kind == code)
            x, y = a[which], b[which]
            if code == 10:
                total = x << 1 | y & 1
                x, y = (total + y) >> 1, (total - y) >> 1
            else:
                x, y = (x, x - y) if code == 8 else (x + y, y)
            a[which], b[which] = x, y
    end = (pos + 7) // 8
    if (end + 2 > len(data)).any():
        raise fail("it ends too early")
    sums = data[end].astype(np.int64) << 8 | data[end + 1]
    if (crc_of(data, starts, end - starts, True) != sums).any():
        raise fail("a wrong frame sum")
    return samples, count, end + 2, number, variable


@dataclass
class Stream:
    """What the blocks before the frames say; points: (sample, byte after `frames`) of the seek table."""

    frames: int
    block: int  #: samples of each block but the last, 0 if they vary
    channels: int
    depth: int
    samples: int
    md5: bytes
    points: list[tuple[int, int]]

    def pcm(self, x: np.ndarray) -> bytes:
        """Samples as little-endian signed numbers of whole bytes, channels in turn."""
        width = -(-self.depth // 8)
        return np.ascontiguousarray(x, "<i8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def read_head(data: bytes) -> Stream:
    """The blocks before a stream's frames."""
    if data[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, info, points, last = 4, None, [], False
    while not last:
        if at + 4 > len(data):
            raise ValueError("the stream's blocks end too early")
        last, kind, n = data[at] >> 7, data[at] & 127, int.from_bytes(data[at + 1 : at + 4], "big")
        body, at = data[at + 4 : at + 4 + n], at + 4 + n
        if len(body) < n:
            raise ValueError("the stream's blocks end too early")
        if kind == 0:
            least, most = struct.unpack(">HH", body[:4])
            packed = int.from_bytes(body[10:18], "big")
            info = (least if least == most else 0, (packed >> 41 & 7) + 1, (packed >> 36 & 31) + 1, packed & ((1 << 36) - 1), body[18:34])
        elif kind == 3:
            points = [p[:2] for p in struct.iter_unpack(">QQH", body[: n - n % 18]) if p[0] != (1 << 64) - 1]
    if info is None:
        raise ValueError("the stream has no information block")
    return Stream(at, *info, points)


@dataclass
class _Chain:
    """Frames in a row, from a seek point on up to the next one."""

    stream: int
    at: int  # in bytes
    place: int  # in samples
    stop: int
    bound: int


def decode(streams: list[bytes], windows: list[tuple[int, int]] | None = None) -> list[np.ndarray]:
    """The samples of each stream (by channel, if there are several), after all sums were found right.

    Frames of all streams are decoded side by side. A seek table need not have all frames: those after a point are
    found one after the other. With windows (first, last) only those samples come back, and only the frames from the
    last seek point before them on are read; a whole stream's MD5 is compared too.
    """
    heads, base, offset = [], [], 0
    for data in streams:
        heads.append(read_head(data))
        base.append(offset)
        offset += len(data)
    data = np.frombuffer(b"".join(streams), np.uint8)
    wanted = [(0, h.samples) if w is None else (max(0, w[0]), max(0, min(w[1], h.samples))) for h, w in zip(heads, windows or [None] * len(heads), strict=True)]
    out = [np.zeros((max(0, last - first), h.channels), np.int64) for h, (first, last) in zip(heads, wanted, strict=True)]
    open_chains = []
    for s, (h, (first, last)) in enumerate(zip(heads, wanted, strict=True)):
        end = base[s] + len(streams[s])
        points = sorted({(0, 0), *((sample, at) for sample, at in h.points if 0 < sample < h.samples)})
        for (sample, at), (stop, to) in zip(points, [*points[1:], (h.samples, end - base[s] - h.frames)]):
            if sample < last and stop > first:
                open_chains.append(_Chain(s, base[s] + h.frames + at, sample, min(stop, last), min(end, base[s] + h.frames + to)))
    while open_chains:
        left = []
        for channels in sorted({heads[c.stream].channels for c in open_chains}):
            same = sorted((c for c in open_chains if heads[c.stream].channels == channels), key=lambda c: c.at)
            for i in range(0, len(same), LANES):
                part = same[i : i + LANES]
                low, high = part[0].at, max(c.bound for c in part)
                x, count, end, number, variable = decode_frames(data[low:high], np.array([c.at - low for c in part], np.int64), np.array([heads[c.stream].depth for c in part], np.int64), channels)
                for row, (c, n, to, k, free) in enumerate(zip(part, count.tolist(), end.tolist(), number.tolist(), variable.tolist(), strict=True)):
                    h, (first, last) = heads[c.stream], wanted[c.stream]
                    if c.place + n > h.samples:
                        raise ValueError("more samples than the stream tells")
                    if (free or h.block) and (k if free else k * h.block) != c.place:
                        raise ValueError("a frame out of its order")
                    a, b = max(c.place, first), min(c.place + n, last)
                    if a < b:
                        out[c.stream][a - first : b - first] = x[row, a - c.place : b - c.place]
                    c.at, c.place = low + to, c.place + n
                    if c.place < c.stop:
                        if c.at >= c.bound:
                            raise ValueError("fewer samples than the stream tells")
                        left.append(c)
        open_chains = left
    for h, x, (first, last) in zip(heads, out, wanted, strict=True):
        if (first, last) == (0, h.samples) and h.md5 != bytes(16) and hashlib.md5(h.pcm(x)).digest() != h.md5:
            raise ValueError("the samples don't have the stream's MD5")
    return [x[:, 0] if x.shape[1] == 1 else x for x in out]


def decode_each(streams: list[bytes | None], windows: list[tuple[int, int]] | None = None) -> list[tuple[np.ndarray | None, str | None]]:
    """(samples, None) of each stream, or (None, what is wrong with it)."""
    try:
        return [(x, None) for x in decode(streams, windows)]
    except (ValueError, TypeError, IndexError, struct.error) as e:
        if len(streams) == 1:
            return [(None, "no stream" if streams[0] is None else str(e) or type(e).__name__)]
        return [decode_each([x], windows and [windows[i]])[0] for i, x in enumerate(streams)]


def payload_of(text: bytes) -> bytes:
    return text + bytes(-len(text) % 64 if text else 64)


def sound_features(x: np.ndarray) -> str:
    """Loudness, zero crossings and range of 8-bit samples, by whole-number sums."""
    square, crossings = int((x * x).sum()), int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    return f"rms={(square / max(1, len(x))) ** 0.5:.4f};crossings={crossings};low={int(x.min())};high={int(x.max())};sum={int(x.sum())}"


def encode_media(docs: DataFrame, rows: int = 1000) -> DataFrame:
    """doc_id, n_bytes (of the text) and media (the FLAC stream of its payload) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, rows, most_bytes=1 << 20):
            texts = as_bytes(batch.column("text"))
            media = encode([payload_of(t) for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, media binary")


def pcm_columns(media: DataFrame, block_samples: int = 1 << 16, first: int = 0, last: int | None = None, rows: int = 1000) -> DataFrame:
    """media without its streams, with what they hold: media_bytes, media_sha256, blocks and error.

    blocks are structs (first_sample, n_samples, pcm) in order: little-endian signed numbers, channels in turn.
    Each begins at a multiple of block_samples. With `first` and `last`, only blocks that have samples of that range are
    decoded. A stream that can't be read has no blocks and an error; null media are such.
    """
    kept = [c for c in media.columns if c not in ("media", "media_bytes", "media_sha256", "blocks", "error")]
    at = first // block_samples * block_samples
    to = None if last is None else -(-last // block_samples) * block_samples

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, rows, "media", 1 << 20):
            streams = batch.column("media").to_pylist()
            firsts, sizes, pcm, ends, errors = [], [], [], [0], []
            whole = at == 0 and to is None
            for data, (x, error) in zip(streams, decode_each(streams, None if whole else [(at, to or 1 << 62)] * len(streams)), strict=True):
                errors.append(error)
                if error is None:
                    head = read_head(data)
                    for low in range(0, len(x), block_samples):
                        part = x[low : low + block_samples]
                        firsts.append(at + low)
                        sizes.append(len(part))
                        pcm.append(head.pcm(part))
                ends.append(len(firsts))
            blocks = pa.StructArray.from_arrays([pa.array(firsts, pa.int64()), pa.array(sizes, pa.int32()), pa.array(pcm, pa.binary())], names=["first_sample", "n_samples", "pcm"])
            own = [pa.array([len(x or b"") for x in streams], pa.int64()), pa.array([hashlib.sha256(x or b"").hexdigest() for x in streams], pa.string())]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), blocks)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *own, lists, pa.array(errors, pa.string())], names=[*kept, "media_bytes", "media_sha256", "blocks", "error"])

    shape = ", ".join(f"`{c}` {media.schema[c].dataType.simpleString()}" for c in kept)
    return media.select(*kept, "media").mapInArrow(run, f"{shape}, media_bytes long, media_sha256 string, blocks array<struct<first_sample:long,n_samples:int,pcm:binary>>, error string")


def pcm_blocks(media: DataFrame, block_samples: int = 1 << 16, first: int = 0, last: int | None = None, rows: int = 1000) -> DataFrame:
    """A row for each block of `pcm_columns`: doc_id, block, first_sample, n_samples, pcm and error; one with an error only for an unreadable stream.

    A sample is found in the block with number sample // block_samples, so a reader of the written blocks filters on
    (doc_id, block) and skips all else.
    """
    found = pcm_columns(media.select("doc_id", "media"), block_samples, first, last, rows)
    found = found.where(F.col("error").isNotNull() | (F.size("blocks") > 0)).select("doc_id", "error", F.explode_outer("blocks").alias("b"))
    return found.select("doc_id", F.floor(F.col("b.first_sample") / block_samples).alias("block"), "b.*", "error")


def media_report(docs: DataFrame, rows: int = 1000) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, n_blocks and error of each row.

    The stored stream is decoded to PCM blocks, and all but media's own figures are read from those.
    """
    names = ("payload_bytes", "payload_sha256", "tail_crc32", "feature")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, rows, "blocks", 4 << 20):
            lists = batch.column("blocks")
            pcm, ends = lists.flatten().field("pcm").to_pylist(), np.asarray(lists.offsets)
            found: dict[str, list] = {n: [] for n in names}
            for i, error in enumerate(batch.column("error").to_pylist()):
                x = np.frombuffer(b"".join(pcm[ends[i] - ends[0] : ends[i + 1] - ends[0]]), np.int8).astype(np.int64)
                back = (x + 128).astype(np.uint8).tobytes()
                said = (len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), sound_features(x)) if error is None else (None,) * 4
                for n, v in zip(names, said, strict=True):
                    found[n].append(v)
            kinds = {"payload_sha256": pa.string(), "feature": pa.string()}
            own = [pa.array(found[n], kinds.get(n, pa.int64())) for n in names]
            n_blocks = pa.array(np.diff(ends).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_bytes", "media_bytes", "media_sha256", "error")), *own, n_blocks], names=["doc_id", "n_bytes", "media_bytes", "media_sha256", "error", *names, "n_blocks"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    decoded = pcm_columns(encode_media(docs, rows), rows=rows)
    return decoded.mapInArrow(run, f"doc_id {kind}, n_bytes long, media_bytes long, media_sha256 string, error string, payload_bytes long, payload_sha256 string, tail_crc32 long, feature string, n_blocks long")
