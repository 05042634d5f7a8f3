"""The factor catalogue: 183 price and volume factors in the algebra of weftline.plans.expr.

o h l c v a vw: open, high, low, close, volume, amount, volume-weighted price; bo, bc: a benchmark's open and close.
"""

from __future__ import annotations

from weftline.plans.expr import (
    E, absolute, corr, cov, cumulative_product, decay, delta, ema, filtered, flag, high, high_day, highest, iff, lag, lift, log, low, low_day, lowest, mean, rank, sign, sign0, slope, sqrt, std,
    total, tsrank, var,
)

EPS = 1e-12


def catalogue() -> dict[int, E]:
    o, h, l, c, v, a, vw, bo, bc = map(var, ("open", "high", "low", "close", "volume", "amount", "vwap", "bench_open", "bench_close"))  # noqa: E741
    c1, h1, l1, o1 = lag(c), lag(h), lag(l), lag(o)
    dc, ret, tp, mid = delta(c), c / lag(c) - 1, (h + l + c) / 3, (h + l) / 2
    R, M, S, sd, mx, mn, wl, tsr = rank, mean, total, std, highest, lowest, decay, tsrank  # noqa: N806
    up, down = c > c1, c < c1
    place = ((c - l) - (h - c)) / (h - l)  # of the close within the day's range
    rsv = lambda n: 100 * (c - mn(l, n)) / (mx(h, n) - mn(l, n))
    off_high = 100 * (mx(h, 6) - c) / (mx(h, 6) - mn(l, 6))
    strength = lambda x, n: 100 * ema(high(x, 0), n, 1) / ema(absolute(x), n, 1)
    gain = lambda x: iff(x > 0, x, 0.0)  # noqa: E731  0 also where x is not known
    gain_share = lambda x, n: 100 * ema(gain(x), n, 1) / ema(absolute(x), n, 1)
    signed_volume = iff(up, v, iff(down, -v, 0.0 * v))
    from_low = iff(c.eq(c1), 0.0, c - iff(up, low(l, c1), high(h, c1)))
    move = high(absolute(h - h1), absolute(l - l1))
    rising = S(iff(h + l >= h1 + l1, 0.0, move), 12)
    falling = S(iff(h + l <= h1 + l1, 0.0, move), 12)
    A, B, C = absolute(h - c1), absolute(l - c1), absolute(h - l1)  # noqa: N806
    gap = absolute(c1 - o1)
    base = iff((A > B) & (A > C), A + B / 2 + gap / 4, iff((B > C) & (B > A), B + A / 2 + gap / 4, C + gap / 4))
    swing = 16 * (dc + (c - o) / 2 + (c1 - o1)) / base * high(A, B)
    true_range = high(h - l, high(absolute(c1 - h), absolute(c1 - l)))
    hd, ld = h - h1, l1 - l
    tr14 = S(high(high(h - l, absolute(h - c1)), absolute(l - c1)), 14)
    plus, minus = S(iff((hd > 0) & (hd > ld), hd, 0.0), 14) * 100 / tr14, S(iff((ld > 0) & (ld > hd), ld, 0.0), 14) * 100 / tr14
    adx = M(absolute(minus - plus) / (minus + plus) * 100, 6)
    vol_up, vol_not = iff(up, sd(c, 20), 0.0), iff(up, 0.0, sd(c, 20))
    span_mean = lambda x: M(x, 12) - M(x, 26)
    dev = ret - M(ret, 20)
    f79, rs162 = strength(dc, 12), gain_share(dc, 12)
    smooth3 = ema(ema(ema(log(c), 13, 2), 13, 2), 13, 2)
    floor1, ceil1 = low(l, c1), high(h, c1)
    part = lambda n: (c - S(floor1, n)) / S(ceil1 - floor1, n)
    open_up, open_down = iff(o > o1, high(h - o, o - o1), 0.0), iff(o < o1, high(o - l, o1 - o), 0.0)
    growth = (c / lag(c, 19)) ** (1 / 20) - 1
    over, under = ret > growth, ret < growth
    x86 = (lag(c, 20) - lag(c, 10)) / 10 - (lag(c, 10) - c) / 10
    s69u, s69d = S(open_up, 20), S(open_down, 20)
    day = (h - l) / (S(c, 5) / 5)
    k28 = ema(rsv(9), 3, 1)
    macd = lambda x: ema(x, 13, 2) - ema(x, 27, 2)
    bench_ret, bench_down = bc / lag(bc) - 1, bc < lag(bc)
    pair_y, pair_x = iff(bench_down, ret, 0.0), iff(bench_down, bench_ret, 0.0)
    n252, known252 = S(flag(bench_down), 252), S(ret * 0 + bench_ret * 0, 252)
    sxy, sx, sy, sxx = S(pair_x * pair_y, 252), S(pair_x, 252), S(pair_y, 252), S(pair_x * pair_x, 252)

    f = {
        1: -corr(R(delta(log(v))), R((c - o) / o), 6),
        2: -delta(place),
        3: S(from_low, 6),
        4: iff(M(c, 8) + sd(c, 8) < M(c, 2), -1.0, iff(M(c, 2) < M(c, 8) - sd(c, 8), 1.0, iff(v / M(v, 20) >= 1, 1.0, -1.0))),
        5: -mx(corr(tsr(v, 5), tsr(h, 5), 5), 3),
        6: -R(sign(delta(0.85 * o + 0.15 * h, 4))),
        7: (R(mx(vw - c, 3)) + R(mn(vw - c, 3))) * R(delta(v, 3)),
        8: R(-delta(0.2 * mid + 0.8 * vw, 4)),
        9: ema((mid - lag(mid)) * (h - l) / v, 7, 2),
        11: S(place * v, 6),
        12: -R(o - M(vw, 10)) * R(absolute(c - vw)),
        13: sqrt(high(h * l, 0)) - vw,
        14: c - lag(c, 5),
        15: o / c1 - 1,
        16: -mx(R(corr(R(v), R(vw), 5, 0.0)), 5),
        17: high(R(vw - mx(vw, 15)), EPS) ** delta(c, 5),
        18: c / lag(c, 5),
        19: iff(c < lag(c, 5), (c - lag(c, 5)) / lag(c, 5), iff(c.eq(lag(c, 5)), 0.0, (c - lag(c, 5)) / c)),
        20: 100 * (c - lag(c, 6)) / lag(c, 6),
        21: slope(M(c, 6), 6),
        22: ema(delta((c - M(c, 6)) / M(c, 6), 3), 12, 1),
        23: 100 * ema(vol_up, 20, 1) / (ema(vol_up, 20, 1) + ema(vol_not, 20, 1)),
        24: ema(c - lag(c, 5), 5, 1),
        25: -R(delta(c, 7) * (1 - R(wl(v / M(v, 20), 9)))) * (1 + R(S(ret, 250))),
        26: M(c, 7) - c + corr(vw, lag(c, 5), 230),
        27: wl(100 * (c - lag(c, 3)) / lag(c, 3) + 100 * (c - lag(c, 6)) / lag(c, 6), 12),
        28: 3 * k28 - 2 * ema(k28, 3, 1),
        29: (c - lag(c, 6)) / lag(c, 6) * v,
        31: 100 * (c - M(c, 12)) / M(c, 12),
        32: -S(R(corr(R(h), R(v), 3, 0.0)), 3),
        33: (lag(mn(l, 5), 5) - mn(l, 5)) * R((S(ret, 240) - S(ret, 20)) / 220) * tsr(v, 5),
        34: M(c, 12) / c,
        35: -low(R(wl(delta(o), 15)), R(wl(corr(v, o, 17), 7))),
        37: -R(delta(S(o, 5) * S(ret, 5), 10)),
        38: iff(M(h, 20) < h, -delta(h, 2), 0.0),
        39: -(R(wl(delta(c, 2), 8)) - R(wl(corr(0.3 * vw + 0.7 * o, S(M(v, 180), 37), 14), 12))),
        40: 100 * S(iff(up, v, 0.0), 26) / S(iff(c <= c1, v, 0.0), 26),
        41: -R(mx(delta(vw, 3), 5)),
        42: -R(sd(h, 10)) * corr(h, v, 10),
        43: S(signed_volume, 6),
        44: tsr(wl(corr(l, M(v, 10), 7), 6), 4) + tsr(wl(delta(vw, 3), 10), 15),
        45: R(delta(0.6 * c + 0.4 * o)) * R(corr(vw, M(v, 150), 15)),
        46: (M(c, 3) + M(c, 6) + M(c, 12) + M(c, 24)) / (4 * c),
        47: ema(off_high, 9, 1),
        48: -R(sign(dc) + sign(lag(dc)) + sign(lag(dc, 2))) * S(v, 5) / S(v, 20),
        49: rising / (rising + falling),
        50: falling / (falling + rising) - rising / (rising + falling),
        51: falling / (falling + rising),
        52: 100 * S(high(0, h - lag(tp)), 26) / S(high(0, lag(tp) - l), 26),
        53: 100 * S(flag(up), 12) / 12,
        54: -R(sd(absolute(c - o), 10) + (c - o) + corr(c, o, 10)),
        55: S(swing, 20),
        56: flag(R(o - mn(o, 12)) < R(R(corr(S(mid, 19), S(M(v, 40), 19), 13)) ** 5)),
        57: ema(rsv(9), 3, 1),
        58: 100 * S(flag(up), 20) / 20,
        59: S(from_low, 20),
        60: S(place * v, 20),
        61: -high(R(wl(delta(vw), 12)), R(wl(R(corr(l, M(v, 80), 8)), 17))),
        62: -corr(h, R(v), 5, 0.0),
        63: strength(dc, 6),
        64: -high(R(wl(corr(R(vw), R(v), 4), 4)), R(wl(mx(corr(R(c), R(M(v, 60)), 4), 13), 14))),
        65: M(c, 6) / c,
        66: 100 * (c - M(c, 6)) / M(c, 6),
        67: strength(dc, 24),
        68: ema((mid - lag(mid)) * ((h - l) / v), 15, 2),
        69: iff(s69u > s69d, (s69u - s69d) / s69u, iff(s69u.eq(s69d), 0.0, (s69u - s69d) / s69d)),
        70: sd(a, 6),
        71: 100 * (c - M(c, 24)) / M(c, 24),
        72: ema(off_high, 15, 1),
        73: -(tsr(wl(wl(corr(c, v, 10), 16), 4), 5) - R(wl(corr(vw, M(v, 30), 4), 3))),
        74: R(corr(S(0.35 * l + 0.65 * vw, 20), S(M(v, 40), 20), 7)) + R(corr(R(vw), R(v), 6)),
        75: S(flag((c > o) & (bc < bo)), 50) / S(flag(bc < bo), 50),
        76: sd(absolute(ret) / v, 20) / M(absolute(ret) / v, 20),
        77: low(R(wl(mid - vw, 20)), R(wl(corr(mid, M(v, 40), 3), 6))),
        78: (tp - M(tp, 12)) / (0.015 * M(absolute(c - M(tp, 12)), 12)),
        79: f79,
        80: 100 * (v - lag(v, 5)) / lag(v, 5),
        81: ema(v, 21, 2),
        82: ema(off_high, 20, 1),
        83: -R(cov(R(h), R(v), 5)),
        84: S(signed_volume, 20),
        85: tsr(v / M(v, 20), 20) * tsr(-delta(c, 7), 8),
        86: iff(x86 > 0.25, -1.0, iff(x86 < 0, 1.0, -dc)),
        87: -(R(wl(delta(vw, 4), 7)) + tsr(wl((l - vw) / (o - mid), 11), 7)),
        88: 100 * (c - lag(c, 20)) / lag(c, 20),
        89: 2 * (macd(c) - ema(macd(c), 10, 2)),
        90: -R(corr(R(vw), R(v), 5)),
        91: -R(c - mx(c, 5)) * R(corr(M(v, 40), l, 5)),
        92: -high(R(wl(delta(0.35 * c + 0.65 * vw, 2), 3)), tsr(wl(absolute(corr(M(v, 180), c, 13)), 5), 15)),
        93: S(iff(o >= o1, 0.0, high(o - l, o - o1)), 20),
        94: S(signed_volume, 30),
        95: sd(a, 20),
        96: ema(ema(rsv(9), 3, 1), 3, 1),
        97: sd(v, 10),
        98: iff(delta(S(c, 100) / 100, 100) / lag(c, 100) <= 0.05, -(c - mn(c, 100)), -delta(c, 3)),
        99: -R(cov(R(c), R(v), 5)),
        100: sd(v, 20),
        101: -flag(R(corr(c, S(M(v, 30), 37), 15)) < R(corr(R(0.1 * h + 0.9 * vw), R(v), 11))),
        102: gain_share(delta(v), 6),
        103: 100 * (20 - low_day(l, 20)) / 20,
        104: -delta(corr(h, v, 5), 5) * R(sd(c, 20)),
        105: -corr(R(o), R(v), 10),
        106: c - lag(c, 20),
        107: -R(o - h1) * R(o - c1) * R(o - l1),
        108: -(R(h - mn(h, 2)) ** R(corr(vw, M(v, 120), 6))),
        109: ema(h - l, 10, 2) / ema(ema(h - l, 10, 2), 10, 2),
        110: 100 * S(gain(h - c1), 20) / S(gain(c1 - l), 20),
        111: ema(v * place, 11, 2) - ema(v * place, 4, 2),
        112: 100 * (S(gain(dc), 12) - S(gain(-dc), 12)) / (S(gain(dc), 12) + S(gain(-dc), 12)),
        113: -R(S(lag(c, 5), 20) / 20) * corr(c, v, 2) * R(corr(S(c, 5), S(c, 20), 2)),
        114: (R(lag(day, 2)) * R(R(v))) / (day / (vw - c)),
        115: R(corr(0.9 * h + 0.1 * c, M(v, 30), 10)) ** R(corr(tsr(mid, 4), tsr(v, 10), 7)),
        116: slope(c, 20),
        117: tsr(v, 32) * (1 - tsr(c + h - l, 16)) * (1 - tsr(ret, 32)),
        118: 100 * S(h - o, 20) / S(o - l, 20),
        119: R(wl(corr(vw, S(M(v, 5), 26), 5), 7)) - R(wl(tsr(mn(corr(R(o), R(M(v, 15)), 21), 9), 7), 8)),
        120: R(vw - c) / R(vw + c),
        121: -(R(vw - mn(vw, 12)) ** tsr(corr(tsr(vw, 20), tsr(M(v, 60), 2), 18), 3)),
        122: delta(smooth3) / lag(smooth3),
        123: -flag(R(corr(S(mid, 20), S(M(v, 60), 20), 9)) < R(corr(l, v, 6))),
        124: (c - vw) / wl(R(mx(c, 30)), 2),
        125: R(wl(corr(vw, M(v, 80), 17), 20)) / R(wl(delta(0.5 * c + 0.5 * vw, 3), 16)),
        126: tp,
        128: 100 - 100 / (1 + S(iff(tp > lag(tp), tp * v, 0.0), 14) / S(iff(tp < lag(tp), tp * v, 0.0), 14)),
        129: S(iff(down, absolute(dc), 0.0), 12),
        130: R(wl(corr(mid, M(v, 40), 9), 10)) / R(wl(corr(R(vw), R(v), 7), 3)),
        131: R(delta(vw)) ** tsr(corr(c, M(v, 50), 18), 18),
        132: M(a, 20),
        133: 100 * ((20 - high_day(h, 20)) / 20 - (20 - low_day(l, 20)) / 20),
        134: (c - lag(c, 12)) / lag(c, 12) * v,
        135: ema(lag(c / lag(c, 20)), 20, 1),
        136: -R(delta(ret, 3)) * corr(o, v, 10),
        137: swing,
        138: -(R(wl(delta(0.7 * l + 0.3 * vw, 3), 20)) - tsr(wl(tsr(corr(tsr(l, 8), tsr(M(v, 60), 17), 5), 19), 16), 7)),
        139: -corr(o, v, 10),
        140: low(R(wl(R(o) + R(l) - R(h) - R(c), 8)), tsr(wl(corr(tsr(c, 8), tsr(M(v, 60), 20), 8), 7), 3)),
        141: -R(corr(R(h), R(M(v, 15)), 9)),
        142: -R(tsr(c, 10)) * R(delta(dc)) * R(tsr(v / M(v, 20), 5)),
        143: cumulative_product(iff(up, (c - c1) / c1, 1.0)),
        144: S(iff(down, absolute(c / c1 - 1) / a, 0.0), 20) / S(flag(down), 20),
        145: 100 * (M(v, 9) - M(v, 26)) / M(v, 12),
        147: slope(M(c, 12), 12),
        148: -flag(R(corr(o, S(M(v, 60), 9), 6)) < R(o - mn(o, 14))),
        149: iff(known252.eq(0.0), (sxy / n252 - sx / n252 * (sy / n252)) / (sxx / n252 - sx / n252 * (sx / n252)) * (n252 - 1) / n252, filtered(lift(0.0), lift(1.0) < 0)),
        150: tp * v,
        151: ema(c - lag(c, 20), 20, 1),
        152: ema(span_mean(lag(ema(lag(c / lag(c, 9)), 9, 1))), 9, 1),
        153: (M(c, 3) + M(c, 6) + M(c, 12) + M(c, 24)) / 4,
        154: flag(vw - mn(vw, 16) < corr(vw, M(v, 180), 18)),
        155: macd(v) - ema(macd(v), 10, 2),
        156: -high(R(wl(delta(vw, 5), 3)), R(wl(-delta(0.15 * o + 0.85 * l, 2) / (0.15 * o + 0.85 * l), 3))),
        157: mn(R(R(log(mn(R(R(-R(delta(c, 5)))), 2)))), 5) + tsr(lag(-ret, 6), 5),
        158: ((h - ema(c, 15, 2)) - (l - ema(c, 15, 2))) / c,
        159: 100 / 504 * (part(6) * 288 + part(12) * 144 + part(24) * 144),
        160: ema(iff(c <= c1, sd(c, 20), 0.0), 20, 1),
        161: M(true_range, 12),
        162: (rs162 - mn(rs162, 12)) / (mx(rs162, 12) - mn(rs162, 12)),
        163: R(-ret * M(v, 20) * vw * (h - c)),
        164: ema(100 * (iff(up, 1 / dc, 1.0) - mn(iff(up, 1 / dc, 1.0), 12)) / (h - l), 13, 2),
        166: -(19**0.5 / 18) * S(dev * dev * dev, 20) / S(dev * dev, 20) ** 1.5,
        167: S(gain(dc), 12),
        168: -v / M(v, 20),
        169: ema(span_mean(lag(ema(dc, 9, 1))), 10, 1),
        170: (R(1 / c) * v / M(v, 20)) * (h * R(h - c) / (S(h, 5) / 5)) - R(vw - lag(vw, 5)),
        171: -((l - c) * (o * o * o * o * o)) / ((c - h) * (c * c * c * c * c)),
        172: adx,
        173: 3 * ema(c, 13, 2) - 2 * ema(ema(c, 13, 2), 13, 2) + smooth3,
        174: ema(iff(c <= c1, sd(c, 20), 0.0), 20, 1),
        175: M(true_range, 6),
        176: corr(R(rsv(12)), R(v), 6),
        177: 100 * (20 - high_day(h, 20)) / 20,
        178: (c - c1) / c1 * v,
        179: R(corr(vw, v, 4)) * R(corr(R(l), R(M(v, 50)), 12)),
        180: iff(M(v, 20) < v, -tsr(absolute(delta(c, 7)), 60) * sign0(delta(c, 7)), -v),
        182: S(flag(((c > o) & (bc > bo)) | ((c < o) & (bc < bo))), 20) / 20,
        184: R(corr(lag(o - c), c, 200)) + R(o - c),
        185: R(-((1 - o / c) * (1 - o / c))),
        186: (adx + lag(adx, 6)) / 2,
        187: S(iff(o <= o1, 0.0, high(h - o, o - o1)), 20),
        188: 100 * (h - l - ema(h - l, 11, 2)) / ema(h - l, 11, 2),
        189: M(absolute(c - M(c, 6)), 6),
        190: log((S(flag(over), 20) - 1) * S(iff(under, (ret - growth) * (ret - growth), 0.0), 20) / (S(flag(under), 20) * S(iff(over, (ret - growth) * (ret - growth), 0.0), 20))),
        191: corr(M(v, 20), l, 5) + mid - c,
    }
    return dict(sorted(f.items()))


#: Numbers that have no formula.
UNUSED = (10, 30, 36, 127, 146, 165, 181, 183)
