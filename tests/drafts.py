"""A plain model of submissions built call by call, and random calls to try it with."""

import json
import math

LISTS = ["data_sources", "data_destinations", "tags"]
OPEN = ["dc", "mrr", "extraction_config"]
SWITCHES = ["curation", "no_extract", "update_metadata_only"]
VALUES = [*OPEN, *SWITCHES, "organization", "links", "acl", "source_name", "external_uri",
          "dataset_acl"]
MAPS = ["index", "services", "projects", "custom"]
LINKS = [[], [{"url": "https://l.example/1"}], [{"type": "paper", "doi": "10.1/x"}],
         [{"url": "u"}, {"description": "second"}]]


def parsed(payload):
    """The value of a payload; raises ValueError where it is no finite JSON."""
    def refuse(word):
        raise ValueError(word)

    def finite(number):
        if math.isinf(float(number)):
            raise ValueError(number)
        return float(number)
    return None if payload is None else json.loads(
        payload, parse_constant=refuse, parse_float=finite)


class Draft:
    """One submission; ``call`` takes the builder calls in order."""

    def __init__(self):
        self.fields = {}

    def call(self, op, field, key, payload):
        try:
            value = parsed(payload)
        except ValueError:
            return
        here = self.fields
        if op == "reset":
            self.fields = {k: v for k, v in here.items() if k in ("test", "update")}
        elif op == "clear":
            here.pop(field, None)
        elif op == "append":
            here.setdefault(field, []).extend(value if isinstance(value, list) else [value])
        elif op == "describe":
            here.setdefault("custom", {}).update({f"{k}_desc": v for k, v in value.items()})
        elif op == "upsert":
            if field == "services" and value is None:
                value = True
            if field == "projects" and not value:
                here.get(field, {}).pop(key, None)
            else:
                here.setdefault(field, {})[key] = value
        elif field == "links":
            here["links"] = here.get("links") or value
        else:
            here[field] = value

    def state(self):
        """Rows (field, key, pos, value) of what holds."""
        for field, value in self.fields.items():
            if field in LISTS:
                yield from ((field, None, n + 1, v) for n, v in enumerate(value))
            elif field in MAPS:
                yield from ((field, k, None, v) for k, v in (value or {}).items())
            elif field != "links" or value:
                yield field, None, None, value

    def document(self):
        """The submission as JSON has it, without parts that are not set."""
        f = self.fields
        listed = lambda name: f.get(name) if isinstance(f.get(name), (list, type(None))) \
            else [f[name]]
        placement = {"organization": f.get("organization"), "links": f.get("links"),
                     "acl": listed("acl"), "source_name": f.get("source_name")}
        out = {"dc": f.get("dc") or {}, "data_sources": f.get("data_sources", []),
               "test": bool(f.get("test")), "update": bool(f.get("update")),
               "update_metadata_only": bool(f.get("update_metadata_only")),
               "placement": {k: v for k, v in placement.items() if v}}
        rest = ["data_destinations", "tags", "mrr", "extraction_config", "external_uri",
                "curation", "no_extract", *MAPS]
        out |= {k: f[k] for k in rest if f.get(k)}
        if listed("dataset_acl"):
            out["dataset_acl"] = listed("dataset_acl")
        return out


def random_calls(draw, n):
    """Builder calls (op, field, key, payload), some with unusable payloads."""
    def one():
        op = draw.choices(["append", "set", "upsert", "describe", "clear", "reset", "switch"],
                          [6, 8, 6, 2, 2, 0.6, 2])[0]
        word = lambda: draw.choice(["north", "süd", 'say "hi"', "a\\b", "0", "x y"])
        block = lambda: draw.choice([{}, {"b": 1}, {"z": [1, {"y": "é"}], "a": None},
                                     {"n": {"m": False}}])
        if op == "append":
            return op, draw.choice(LISTS), None, draw.choice([word(), [word(), word()], []])
        if op == "describe":
            return op, "custom", None, {draw.choice(["depth", "kind"]): word()}
        if op == "clear":
            return op, draw.choice([*LISTS, *MAPS, *VALUES]), None, None
        if op == "reset":
            return op, None, None, None
        if op == "switch":
            return "set", draw.choice(["test", "update"]), None, draw.choice([True, False])
        if op == "upsert":
            field = draw.choice(MAPS[:3])
            value = {"index": lambda: {"mapping": {word(): word()},
                                       **draw.choice([{}, {"delimiter": ";", "na_values": ["-"]}])},
                     "services": lambda: draw.choice([None, False, True, {"area": word()}]),
                     "projects": lambda: draw.choice([None, 0, {}, {"lead": word()}, 7])}[field]()
            return op, field, draw.choice(["k1", "k2"]), value
        field = draw.choice([*VALUES, "custom"])
        if field in OPEN:
            return op, field, None, block()
        if field in SWITCHES:
            return op, field, None, draw.choice([True, False])
        return op, field, None, {
            "custom": lambda: draw.choice([{}, {"depth": word(), "kind": 3}, {"rate": 0.5}]),
            "links": lambda: draw.choice(LINKS),
            "acl": lambda: draw.choice([word(), [word(), "public"]]),
            "dataset_acl": lambda: draw.choice([word(), [word()]])}.get(field, word)()
    calls = []
    for _ in range(n):
        op, field, key, value = one()
        payload = None if op in ("clear", "reset") else json.dumps(value)
        if draw.random() < 0.06 and payload and op != "append":
            payload = draw.choice(['{"a": NaN}', '{"a": -1e999}', '{"a"', "[Infinity]"])
        calls.append((op, field, key, payload))
    return calls


def random_log(draw, submissions, longest):
    """Rows (submission_id, seq, op, field, key, payload), and the drafts they make."""
    rows, drafts = [], {}
    for number in range(submissions):
        drafts[number] = Draft()
        for seq, call in enumerate(random_calls(draw, draw.randint(1, longest))):
            rows.append((number, seq, *call))
            drafts[number].call(*call)
    return rows, drafts
