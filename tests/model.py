"""A literal, single-threaded model of the consumer's poll loop, used as the
reference for the set-based Spark operators. Messages are dicts with topic,
partition, offset, ts (None = no timestamp)."""

MAX = (1 << 63) - 1


class PollModel:
    def __init__(self, ranges, batch_size=None):
        # ranges: {(topic, partition): (start, end)}
        self.ranges = dict(ranges)
        self.cap = batch_size
        self.state = {}
        for tp, (s, e) in self.ranges.items():
            done = s >= e
            self.state[tp] = dict(consumed=s, released=s, ts=None, caught=done, live=done)
        self.held = []

    def lwm(self):
        vals = [st["ts"] for st in self.state.values() if not st["caught"] and st["ts"] is not None]
        return min(vals) if vals else None

    def limit(self):
        if self.state and all(st["caught"] for st in self.state.values()):
            return MAX
        m = self.lwm()
        return MAX if m is None else m

    def poll(self, arrivals):
        got = False
        for m in arrivals:
            if m["ts"] is None:
                continue
            tp = (m["topic"], m["partition"])
            st = self.state.get(tp)
            if st is not None:
                st["consumed"] = m["offset"]
                st["ts"] = m["ts"]
                st["caught"] = m["offset"] + 1 >= self.ranges[tp][1]
            self.held.append(m)
            got = True
        if got:
            self.held.sort(key=lambda m: m["ts"])
        lim = self.limit()
        pool = self.held if self.cap is None else self.held[: self.cap]
        n = 0
        for m in pool:
            if m["ts"] <= lim:
                n += 1
            else:
                break
        out, self.held = self.held[:n], self.held[n:]
        for m in out:
            tp = (m["topic"], m["partition"])
            st = self.state.get(tp)
            if st is not None:
                st["released"] = m["offset"]
                st["live"] = m["offset"] + 1 >= self.ranges[tp][1]
        return out, lim

    def is_live(self):
        return bool(self.state) and all(st["live"] for st in self.state.values())


def run(ranges, polls, batch_size=None, drain=False):
    """Return [(released, limit, state snapshot)] per poll. Arrivals inside a
    poll are fed in (topic, partition, offset) order."""
    model = PollModel(ranges, batch_size)
    out = []
    for arrivals in polls:
        rel, lim = model.poll(sorted(arrivals, key=lambda m: (m["topic"], m["partition"], m["offset"])))
        out.append((rel, lim, {k: dict(v) for k, v in model.state.items()}))
    while drain and model.held:
        rel, lim = model.poll([])
        if not rel:
            break
        out.append((rel, lim, {k: dict(v) for k, v in model.state.items()}))
    return out
