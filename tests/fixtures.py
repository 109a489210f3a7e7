"""Small raw files as the weather service would publish them, built per test."""

import json
import os

# Header texts as the services write them.
COMMON = ["観測所番号", "都道府県", "地点", "国際地点番号",
          "現在時刻(年)", "現在時刻(月)", "現在時刻(日)", "現在時刻(時)", "現在時刻(分)"]
HEADERS = {
    "precipitation": ["{d}日の値(mm)", "{d}日の値の品質情報"],
    "max_temperature": ["{d}日の最高気温(℃)", "{d}日の最高気温の品質情報", "{d}日の最高気温起時（時）"],
    "min_temperature": ["{d}日の最低気温(℃)", "{d}日の最低気温の品質情報", "{d}日の最低気温起時（時）"],
    "max_wind": ["{d}日の最大値(m/s)", "{d}日の最大値の品質情報", "{d}日の最大値観測時の風向",
                 "{d}日の最大値観測時の風向の品質情報", "{d}日の最大値起時（時）"],
    "max_gust": ["{d}日の最大値(m/s)", "{d}日の最大値の品質情報", "{d}日の最大値観測時の風向",
                 "{d}日の最大値観測時の風向の品質情報", "{d}日の最大値起時（時）"],
}
MASTER = ["観測所番号", "観測所名", "緯度(度)", "緯度(分)", "経度(度)", "経度(分)"]


def headers(name, day):
    return [h.format(d=day) for h in HEADERS[name]]


def csv_text(name, rows, day, order=None):
    """``rows`` are ``(station, wmo, (y, m, d, h, mi), values)``; ``order`` permutes the columns."""
    names = [*COMMON, *headers(name, day)]
    lines = [names, *([s, "県", "地点", w, *time, *values] for s, w, time, values in rows)]
    if order is not None:
        lines = [[line[i] for i in order] for line in lines]
    return "".join(",".join(line) + "\r\n" for line in lines)


def time_parts(date, hour="14", minute="00"):
    return (f"{date.year:04d}", f"{date.month:02d}", f"{date.day:02d}", hour, minute)


def measured(name, base):
    value = f"{base:.1f}"
    return [value, "8", "10"] if name.endswith("temperature") else (
        [value, "8"] if name == "precipitation" else [value, "8", "北北西", "8", "13"]
    )


def result(station, date, types=(), plants=(), days=1):
    day = {
        "date": {"year": date.year, "month": date.month, "day": date.day},
        "pollenTypeInfo": [{"code": c, **({"indexInfo": {"value": v}} if v is not None else {})} for c, v in types],
        "plantInfo": [
            {"code": c, **({"indexInfo": {"value": v}} if v is not None else {}), "plantDescription": {"type": t}}
            for c, t, v in plants
        ],
    }
    return {
        "station_id": station,
        "latitude": 35.0,
        "longitude": 139.0,
        "response": {"regionCode": "JP", "dailyInfo": [day] * days},
    }


def envelope(results):
    return json.dumps({"results": results}, ensure_ascii=False, separators=(",", ":"))


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as file:
        file.write(data)
    return path


def write_snapshot(root, date, stations, hours=None, skip=(), orders=None, base=20.0):
    """The six raw objects of a day; ``stations`` maps ids to WMO ids (empty for none)."""
    key = f"{date:%Y%m%d}"
    for i, name in enumerate(HEADERS):
        if f"{name}.csv" in skip:
            continue
        hour = (hours or {}).get(name, "14")
        rows = [
            (s, w, time_parts(date, hour), measured(name, base + i + n))
            for n, (s, w) in enumerate(stations.items())
        ]
        text = csv_text(name, rows, date.day, (orders or {}).get(name))
        write(f"{root}/{key}/{name}.csv", text.encode("shift_jis"))
    if "pollen.json" not in skip:
        results = [
            result(s, date, types=[("TREE", 3)], plants=[("OAK", "TREE", 1), ("BIRCH", "TREE", 3)])
            for s, w in stations.items()
            if w
        ]
        write(f"{root}/{key}/pollen.json", envelope(results).encode())
    return root


def write_master(path, rows):
    text = "".join(",".join(line) + "\r\n" for line in [MASTER, *rows])
    return write(path, text.encode("cp932"))
