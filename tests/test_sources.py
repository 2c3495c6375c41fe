"""Files: round trips and parsers."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from altiplano import config
from altiplano.kernels.tiles import unpack
from altiplano.sources import geojson, images, ply, rpcfile


def test_tiff(spark, tmp_path):
    r = np.random.default_rng(1)
    for im in (r.integers(0, 60000, (300, 270)).astype("u2"), r.normal(size=(2, 70, 90)).astype("f4"), r.integers(-9, 9, (3, 20, 30)).astype("i2")):
        t = images.Tiff(images.write_tiff(im, block=64))
        want = im[None] if im.ndim == 2 else im
        assert np.array_equal(t.read(), want.astype(float))
    im = r.integers(1, 255, (100, 120)).astype("u1")
    im[5, 6] = 255
    images.write_image(str(tmp_path / "a.tif"), im, 255)
    t = images.Tiff((tmp_path / "a.tif").read_bytes())
    w = t.window(-2, 3, 10, 5)[0]
    assert np.isnan(w[:, :2]).all() and np.isnan(w[2, 8]) and w[0, 2] == im[3, 0]
    plan = spark.createDataFrame([(1, 0, 0, 50, 40), (2, 100, 80, 50, 40)], "t int, x int, y int, w int, h int")
    got = {x["t"]: unpack(x["h"], x["w"], x["data"]) for x in images.read_windows(spark, str(tmp_path / "a.tif"), plan, ["t"]).collect()}
    assert got[1][10, 10] == im[10, 10] and np.isnan(got[2][30, 30]) and got[2][0, 0] == im[80, 100]
    with pytest.raises(NotImplementedError):
        images.write_image(str(tmp_path / "a.jpg"), im)


def test_png():
    r = np.random.default_rng(2)
    for im in (r.integers(0, 255, (13, 17)).astype("u1"), r.integers(0, 65000, (9, 5)).astype("u2"), r.integers(0, 255, (3, 8, 9)).astype("u1")):
        assert np.array_equal(images.read_png(images.write_png(im)), im[None] if im.ndim == 2 else im)


def test_ply(spark, tmp_path):
    ply.register(spark)
    df = spark.range(500).select((F.col("id") * 1.5).alias("x"), (-F.col("id") / 7.0).alias("y"), F.lit(2.0).cast("float").alias("z"), (F.col("id") % 256).cast("short").alias("red"))
    df.repartition(3).write.format("ply").mode("append").option("comments", "projection: CRS 32740").save(str(tmp_path / "c"))
    back = spark.read.format("ply").load(str(tmp_path / "c"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert ply.comments(next(map(str, (tmp_path / "c").glob("*.ply")))) == ["projection: CRS 32740"]
    (tmp_path / "a.ply").write_text("ply\nformat ascii 1.0\nelement vertex 2\nproperty float x\nproperty uchar red\nend_header\n1.5 3\n2.5 4\n")
    assert [tuple(r) for r in spark.read.format("ply").load(str(tmp_path / "a.ply")).collect()] == [(1.5, 3), (2.5, 4)]
    assert ply.colour_columns(1) == ["red", "green", "blue"] and len(ply.colour_columns(4)) == 4
    with pytest.raises(ValueError):
        ply.colour_columns(2)


def _coefficients(k):
    return [round(0.1 * i + k, 2) for i in range(20)]


def test_camera_files(spark, tmp_path):
    text = "\n".join([f"{t}: {10 + i} pixels" for i, t in enumerate(rpcfile.TEXT_TAGS)] + [f"{t}_{i + 1}: {v}" for k, t in enumerate(rpcfile.TEXT_ARRAYS) for i, v in enumerate(_coefficients(k))])
    (tmp_path / "a.txt").write_text(text)
    listed = "".join(f"<{t}>{20 + i}</{t}>" for i, (t, n) in enumerate(rpcfile.LIST_XML.items()) if "_num" not in n and "_den" not in n)
    listed += "".join(f"<{t}List>\n<{t}> {' '.join(map(str, _coefficients(k)))} </{t}>\n</{t}List>" for k, t in enumerate(t for t, n in rpcfile.LIST_XML.items() if "_num" in n or "_den" in n))
    (tmp_path / "b.xml").write_text(f"<isd><SATID>\"WV02\"</SATID>{listed}</isd>")
    half = lambda k: "".join(f"<{a}_{i + 1}>{v}</{a}_{i + 1}>" for j, a in enumerate(("SAMP_NUM_COEFF", "SAMP_DEN_COEFF", "LINE_NUM_COEFF", "LINE_DEN_COEFF")) for i, v in enumerate(_coefficients(k + j)))
    plain = "".join(f"<{t}>{30 + i}</{t}>" for i, t in enumerate(rpcfile.PLAIN_XML))
    (tmp_path / "c.xml").write_text(f"<d><METADATA_PROFILE>PHR_SENSOR</METADATA_PROFILE><Direct_Model>{half(0)}</Direct_Model><Inverse_Model>{half(5)}</Inverse_Model>{plain}</d>")
    (tmp_path / "d.txt").write_text("nothing")
    files = rpcfile.read_files(spark, str(tmp_path))
    assert {r.file[-5:]: r.kind for r in files.collect()} == {"a.txt": "text", "b.xml": "worldview", "c.xml": "pleiades", "d.txt": None}
    a = rpcfile.parse_text(files).first().rpc
    assert a.row_offset == 10 and a.row_num == _coefficients(0) and a.col_den == _coefficients(3)
    b = rpcfile.parse_worldview(files).first().rpc
    assert b.row_offset == 20 and b.row_num == _coefficients(0) and b.col_den == _coefficients(3)
    c = rpcfile.parse_pleiades(files).first().rpc
    assert c.row_offset == 29 and c.lat_offset == 32 and c.lon_num == _coefficients(0) and c.col_num == _coefficients(5) and c.row_den == _coefficients(8)


def test_metadata_and_matrices(spark):
    lines = spark.createDataFrame([("  NITF_LINE_OFF=12.5",), ("  NITF_LINE_NUM_COEFF=1 2 3",), ("junk",)], "value string")
    assert sorted(map(tuple, rpcfile.metadata_lines(lines).collect())) == [("LINE_NUM_COEFF_1", "1"), ("LINE_NUM_COEFF_2", "2"), ("LINE_NUM_COEFF_3", "3"), ("LINE_OFF", "12.5")]
    m = spark.createDataFrame([("[1, 2 3;\n4 5 6\t7 8 -9e1]",), ("1 2",)], "t string").select(rpcfile.matrix(F.col("t"), 3, 3).alias("m")).collect()
    assert m[0].m == [1, 2, 3, 4, 5, 6, 7, 8, -90] and m[1].m is None


def test_geojson(spark, tmp_path):
    ring = [[55.6, -21.2], [55.7, -21.2], [55.7, -21.3], [55.6, -21.2]]
    (tmp_path / "p.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]}}]}))
    got = geojson.read(spark, str(tmp_path / "p.json")).first().ring
    assert [[p.lon, p.lat] for p in got] == ring
    assert spark.createDataFrame([("{}",)], "t string").select(geojson.ring(F.col("t")).alias("r")).first().r is None


def test_config(tmp_path):
    user = {"out_dir": "out", "images": [{"img": "a.tif", "rpc": "a.json"}, {"img": "/abs/b.tif"}], "roi": {"x": 150.7, "y": 149.2, "w": 699.1, "h": 700}, "tile_size": 300, "3d_filtering_r": 5}
    (tmp_path / "config.json").write_text(json.dumps(user))
    cfg = config.read(str(tmp_path / "config.json"))
    assert cfg.roi == config.Roi(150, 149, 700, 700) and cfg.tile_size == 300 and cfg.filter_3d_r == 5 and cfg.dsm_resolution == 4
    assert cfg.images[0].img == str(tmp_path / "a.tif") and cfg.images[1].img == "/abs/b.tif" and cfg.out_dir == str(tmp_path / "out")
    assert json.loads(cfg.to_json())["out_dir"] == "." and json.loads(cfg.to_json())["3d_filtering_r"] == 5
    for bad in ({"images": user["images"][:1], "roi": user["roi"]}, {"images": user["images"]}, {"images": user["images"], "roi": {"x": 1}}, {**user, "use_srtm": True, "exogenous_dem": "d.tif"}):
        with pytest.raises(config.ConfigError):
            config.build(bad)
    with pytest.warns(UserWarning):
        assert config.build({**user, "mystery": 1}).extra == {"mystery": 1}


def _lzw(data):
    """A plain encoder, for the decoder's test."""
    table, codes, now = {bytes([i]): i for i in range(256)}, [(256, 9)], b""
    size, width = 258, 9
    for i in range(len(data)):
        b = data[i : i + 1]
        if now + b in table:
            now += b
            continue
        codes.append((table[now], width))
        table[now + b] = size
        size += 1
        width = min(12, max(9, size.bit_length()))
        if size == 4094:
            codes.append((256, width))
            table, size, width = {bytes([i]): i for i in range(256)}, 258, 9
        now = b
    codes += [(table[now], width)] if now else []
    codes.append((257, min(12, max(9, (size + 1).bit_length()))))
    bits = "".join(format(c, f"0{w}b") for c, w in codes)
    bits += "0" * (-len(bits) % 8)
    return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))


def test_lzw_and_big_tiff():
    import struct

    import numpy as np

    from altiplano.sources import images

    r = np.random.default_rng(2)
    for n in (0, 1, 300, 9000):
        data = r.integers(0, 4, n).astype(np.uint8).tobytes()
        assert images.lzw_decode(_lzw(data)) == data
    im = r.integers(0, 50, (20, 30)).astype("<u2")
    raw = _lzw(im.tobytes())
    entries = [(256, 4, 30), (257, 4, 20), (258, 3, 16), (259, 3, 5), (273, 16, 0), (277, 3, 1), (278, 4, 20), (279, 4, len(raw)), (339, 3, 1)]
    start = 16 + 8 + 20 * len(entries) + 8
    body = b"".join(struct.pack("<HHQQ", tag, kind, 1, start if tag == 273 else value) for tag, kind, value in entries)
    tiff = images.Tiff(b"II" + struct.pack("<HHHQ", 43, 8, 0, 16) + struct.pack("<Q", len(entries)) + body + struct.pack("<Q", 0) + raw)
    assert (tiff.read()[0] == im).all()
    assert tiff.camera() is None
    tiff.tags[50844] = tuple(range(92))
    assert tiff.camera()["row_offset"] == 2 and tiff.camera()["col_den"][-1] == 91
