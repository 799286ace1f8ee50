"""Hand-made 13-field post fixture and a plain-Python model of every task.

The model works on the raw lines with list and dict code only, so it is an
independent check of the Spark plans on a small input.
"""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timezone

BASE_MS = 1_443_600_000_000  # 2015-09-30 08:00:00 UTC

VOCAB = ["the", "and", "of", "to", "in", "is", "they", "Our", "river", "Under", "MAY", "tea", "north",
         "b", "O", "y", "Größe", "naïve", "🚲", "#walk", "note:", "isn't", "(sic)", '"said', "año",
         "Übung", "love", "city", "train", "bread"]

STOP_WORDS = ["the", "and", "of", "to", "in", "is"]


def _post(ms, country, code, ptype, place, lang, user, off, text, lat, lon):
    fields = [str(ms), country, code, ptype, place, lang, user, user.upper(), str(off), "42", text, lat, lon]
    return "\t".join(fields)


def post_lines(seed: int = 7) -> list[str]:
    rnd = random.Random(seed)
    rows: list[str] = []

    def text():
        return " ".join(rnd.choice(VOCAB) for _ in range(rnd.randint(1, 9)))

    def add(n, country, code, places, lang, off, lat0, lon0, ptype="city"):
        for i in range(n):
            place = places[i % len(places)]
            ms = BASE_MS + rnd.randint(0, 86_400_000 * 2)
            lat = f"{lat0 + rnd.uniform(-1, 1):.8f}"
            lon = f"{lon0 + rnd.uniform(-1, 1):.8f}"
            user = f"user{rnd.randint(0, 40)}"
            rows.append(_post(ms, country, code, ptype, place, lang, user, off, text(), lat, lon))

    us_cities = ["Chicago, IL"] * 9 + ["Los Angeles, CA"] * 7 + ["Manhattan, NY"] * 7 + \
                ["Houston, TX"] * 5 + ["Austin, TX"] * 5 + ["Portland"] * 4 + ["Boise, ID"] * 2
    add(len(us_cities), "United States", "US", us_cities, "en", -18000, 39.0, -98.0)
    add(6, "United States", "US", ["Texas", "Oregon"], "en", -21600, 31.0, -99.0, ptype="admin")
    add(11, "Norway", "NO", ["Oslo"], "no", 7200, 60.0, 10.0)          # tie with Sweden
    add(11, "Sweden", "SE", ["Stockholm"], "sv", 7200, 59.3, 18.0)
    add(10, "Belize", "BZ", ["Belize City"], "en", -21600, 17.5, -88.2)  # exactly 10: no centroid
    add(12, "Österreich", "AT", ["Wien"], "de", 3600, 48.2, 16.4)
    add(3, "", "", ["Nowhere"], "und", 0, -54.8, -159.8)               # blank country is a group
    add(4, "Australia", "AU", ["Portland"], "en", 36000, -38.3, 141.6, ptype="admin")  # same place name

    # Specific texts.
    specials = ["  double  blank  ", "", "UPPER Case WORDS", "Ünïcödé wörds ÄÖ Straße", "emoji 😀 here 😀",
                'quote " unbalanced', "a b c single letters", "Chicago love the city the"]
    for i, t in enumerate(specials):
        rows.append(_post(BASE_MS + i * 1000, "United States", "US", "city", "Chicago, IL", "en", f"special{i}",
                          -18000, t, "41.8", "-87.6"))
    # Local hours crossing midnight in both directions.
    rows.append(_post(BASE_MS - 8 * 3_600_000 - 60_000, "Kiribati", "KI", "city", "Tarawa", "en", "k1", 50400,
                      "late", "1.3", "173.0"))
    rows.append(_post(BASE_MS - 8 * 3_600_000 + 60_000, "Samoa", "WS", "city", "Apia", "en", "s1", -39600,
                      "early", "-13.8", "-171.7"))
    # Two hours tied for the mode in one country (02:xx and 05:xx, twice each).
    for h in (2, 2, 5, 5):
        rows.append(_post(BASE_MS - 8 * 3_600_000 + h * 3_600_000, "Fiji", "FJ", "city", "Suva", "en", "f1", 0,
                          "tie", "-18.1", "178.4"))
    # A short line and a non-numeric latitude.
    rows.append("1443600000000\tNorway\tNO")
    rows.append(_post(BASE_MS, "Sweden", "SE", "city", "Stockholm", "sv", "badlat", 7200, "bad lat", "abc", "18.0"))
    return rows


# ----------------------------------------------------------------- plain model

NAMES = ["utc_time", "country_name", "country_code", "place_type", "place_name", "language", "username",
         "user_screen_name", "timezone_offset", "number_of_friends", "tweet_text", "latitude", "longitude"]


def _num(s, kind):
    if s is None:
        return None
    try:
        return kind(float(s)) if kind is int else float(s)
    except ValueError:
        return None


def parse(lines: list[str]) -> list[dict]:
    out = []
    for line in lines:
        parts = line.split("\t")
        rec = {n: (parts[i] if i < len(parts) else None) for i, n in enumerate(NAMES)}
        rec["utc_time"] = _num(rec["utc_time"], int)
        rec["timezone_offset"] = _num(rec["timezone_offset"], int)
        rec["number_of_friends"] = _num(rec["number_of_friends"], int)
        rec["latitude"] = _num(rec["latitude"], float)
        rec["longitude"] = _num(rec["longitude"], float)
        out.append(rec)
    return out


def _mean(xs):
    xs = [x for x in xs if x is not None]
    return sum(xs) / len(xs) if xs else None


def model_profile(recs):
    texts = [r["tweet_text"] for r in recs if r["tweet_text"] is not None]
    distinct = lambda k: len({r[k] for r in recs if r[k] is not None})
    lats = [r["latitude"] for r in recs if r["latitude"] is not None]
    lons = [r["longitude"] for r in recs if r["longitude"] is not None]
    return [len(recs), distinct("username"), distinct("country_name"), distinct("place_name"),
            distinct("language"), min(lats), min(lons), max(lats), max(lons),
            _mean([len(t) for t in texts]), _mean([len(t.split(" ")) for t in texts])]


def ranked_counts(keys):
    c = Counter(keys)
    return sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))


def model_country_counts(recs):
    return ranked_counts(r["country_name"] for r in recs)


def model_centroids(recs, min_n=11):
    by = defaultdict(list)
    for r in recs:
        by[r["country_name"]].append(r)
    return {k: (_mean([r["latitude"] for r in v]), _mean([r["longitude"] for r in v]))
            for k, v in by.items() if len(v) >= min_n}


def local_hour(ms, off):
    return datetime.fromtimestamp(ms / 1000 + off, tz=timezone.utc).hour


def model_peak_hour(recs):
    by = defaultdict(Counter)
    for r in recs:
        if r["utc_time"] is not None and r["timezone_offset"] is not None:
            by[r["country_name"]][local_hour(r["utc_time"], r["timezone_offset"])] += 1
    return {k: min(c.items(), key=lambda hc: (-hc[1], hc[0])) for k, c in by.items()}


def model_us_city_counts(recs):
    return ranked_counts(r["place_name"] for r in recs if r["country_code"] == "US" and r["place_type"] == "city")


def tokens_of(text):
    return [t.lower() for t in text.split(" ") if len(t) >= 2]


def model_top_us_words(recs, stop, k=10):
    c = Counter(w for r in recs if r["country_code"] == "US" and r["tweet_text"] is not None
                for w in tokens_of(r["tweet_text"]) if w not in stop)
    return sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:k]


def model_top_words_of_top_cities(recs, stop, k_cities=5, k_words=10):
    cities = [c for c, _ in model_us_city_counts(recs)[:k_cities]]
    out = {}
    for city in cities:
        c = Counter(w for r in recs if r["place_name"] == city and r["tweet_text"] is not None
                    for w in tokens_of(r["tweet_text"]) if w not in stop)
        out[city] = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:k_words]
    return out


def model_scores(recs, query_words):
    ws = list(dict.fromkeys(w.lower() for w in query_words))
    n_total = len(recs)
    texts = defaultdict(list)
    for r in recs:
        if r["place_name"] is not None and r["tweet_text"] is not None:
            texts[r["place_name"]].append(set(r["tweet_text"].lower().split(" ")))
    scores = {}
    for place, sets in texts.items():
        n = len(sets)
        p = n / n_total
        for w in ws:
            p = p * sum(1 for s in sets if w in s) / n
        scores[place] = p
    return scores


def model_best(scores):
    if not scores:
        return {}
    top = max(scores.values())
    return {k: v for k, v in scores.items() if v == top and top > 0}
