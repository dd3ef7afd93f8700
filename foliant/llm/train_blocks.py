"""Train the weights of ``blocks.py`` on generated pages: ``python -m foliant.llm.train_blocks``.

Pages are drawn from random templates: semantic tags or plain containers with telling or
meaningless class names, in any order, with articles of headings, paragraphs, lists, quotes
and tables, and around or inside them menus, headers, sidebars, notices, adverts, forms,
reader comments and footers.  Words are invented, so the network has to use structure,
place and stock phrases rather than vocabulary.
"""

from __future__ import annotations

import html
import random
import sys

import numpy as np

from .blocks import DIM, HIDDEN, WEIGHTS, Leaf, leaves, load_weights, lstm, vectors

MAIN, REST = "\ue001", "\ue000"
SYLLABLES = "th on er an re he in ed nd ha at en es of or nt ea ti to it st is ar ou é è ç ment tion eau ung sch ß ä ö keit ción ñ á í lo ra wa ko mi shi ta zo".split()
STOCK = {
    "nav": "home news about contact login register search menu blog archive shop help sports".split(),
    "header": ["the daily paper", "welcome to our site", "your trusted source", "skip to content", "log in"],
    "notice": ["we use cookies to improve your experience", "accept all cookies", "this site uses cookies", "privacy settings", "please enable javascript", "wir verwenden cookies", "nous utilisons des cookies", "usamos cookies"],
    "ad": ["advertisement", "sponsored content", "buy now and save", "special offer", "anzeige", "publicité", "publicidad"],
    "form": ["subscribe to our newsletter", "enter your email", "send", "your name", "submit", "sign up"],
    "comments": ["comments", "leave a reply", "reply", "3 comments", "great article thanks", "i disagree", "kommentare", "commentaires"],
    "sidebar": ["related posts", "most read", "popular", "tags", "recent articles", "you may also like"],
    "footer": ["© 2024 all rights reserved", "privacy policy", "terms of use", "imprint", "contact us", "copyright"],
}
NAMES = {
    "nav": "nav menu navbar navigation topnav breadcrumb breadcrumbs main-menu".split(),
    "header": "header masthead site-header top banner branding".split(),
    "notice": "cookie cookie-notice notice consent gdpr alert popup modal cookie-banner overlay".split(),
    "ad": "ad ads advert advertisement sponsored promo banner-ad ad-slot adbox".split(),
    "form": "newsletter subscribe signup search-form form login".split(),
    "comments": "comments comment comment-list discussion replies responses reader-comments".split(),
    "sidebar": "sidebar aside widget related rail recommended secondary".split(),
    "footer": "footer site-footer bottom legal colophon copyright".split(),
    "main": "content article post entry story main article-body post-content entry-content text body prose".split(),
}
TAGS = {"nav": ["nav"], "header": ["header"], "notice": ["div", "section", "dialog"], "ad": ["div", "aside", "ins"], "form": ["form"], "comments": ["section", "div", "ol"], "sidebar": ["aside"], "footer": ["footer"], "main": ["article", "main", "section"]}


class Writer:
    def __init__(self, rnd: random.Random):
        self.rnd, self.semantic, self.named = rnd, rnd.random() < 0.7, rnd.random() < 0.7
        if not self.semantic and not self.named:
            self.semantic = True
        self.vocabulary = ["".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 4))) for _ in range(150)]
        self.junk = rnd.choice(["symbols", "bars", "shout", "repeat"]) if rnd.random() < 0.3 else ""

    def words(self, n: int) -> str:
        words = self.rnd.choices(self.vocabulary, k=n)
        if self.junk == "symbols":
            words = [w + self.rnd.choice(["###", "$$$", "&&&", "%%%", "***"]) for w in words]
        elif self.junk == "bars":
            words = [w + " |" for w in words]
        elif self.junk == "shout":
            words = [w.upper() + "!!" for w in words]
        elif self.junk == "repeat":
            words = [words[i // 6] for i in range(n)]
        for i in range(n - 1, -1, -self.rnd.randint(6, 14)):
            words[i] += "."
        if self.rnd.random() < (0.5 if self.junk else 0.15):
            words[-1] = words[-1].rstrip(".")
        return " ".join(words).capitalize()

    def mark(self, text: str, label: str) -> str:
        return label + html.escape(text, quote=False)

    def wrap(self, kind: str, inner: str) -> str:
        rnd = self.rnd
        tag = rnd.choice(TAGS[kind]) if self.semantic and rnd.random() < 0.9 or kind == "form" else "div"
        name = f' {rnd.choice(["class", "class", "id"])}="{rnd.choice(NAMES[kind])}"' if self.named and rnd.random() < 0.85 or tag == "div" and kind != "main" else ""
        return f"<{tag}{name}>{inner}</{tag}>"

    def stock(self, kind: str) -> str:
        return self.rnd.choice(STOCK[kind]).capitalize() if self.rnd.random() < 0.4 else self.words(self.rnd.randint(1, 14))

    def links(self, n: int, longest: int = 3) -> str:
        rnd, out = self.rnd, []
        for _ in range(n):
            text = rnd.choice(STOCK["nav"]) if rnd.random() < 0.4 else self.words(rnd.randint(1, longest)).strip(".")
            out.append(f'<a href="/{rnd.randint(1, 999)}">{self.mark(text, REST)}</a>')
        style = rnd.random()
        if style < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" if rnd.random() < 0.9 else f"<li>{x}" for x in out) + "</ul>"
        return "".join(f"<div>{x}</div>" if style < 0.8 else f"{x}<br>" for x in out)

    def part(self, kind: str) -> str:
        rnd = self.rnd
        p = lambda n: f"<p>{self.mark(self.words(n), REST)}</p>"
        if kind == "nav":
            inner = self.links(rnd.randint(2, 9))
        elif kind == "sidebar":
            inner = f"<h3>{self.mark(self.stock(kind), REST)}</h3>" * (rnd.random() < 0.7) + (self.links(rnd.randint(2, 6), 8) if rnd.random() < 0.6 else p(rnd.randint(5, 50)))
        elif kind == "form":
            inner = f"<label>{self.mark(self.stock(kind), REST)}</label><input name=x><button>{self.mark(self.stock(kind), REST)}</button>"
            inner = (p(rnd.randint(3, 20)) if rnd.random() < 0.4 else "") + inner
        elif kind == "comments":
            head = f"<h3>{self.mark(self.stock(kind), REST)}</h3>" if rnd.random() < 0.7 else ""
            item = lambda: f"<div{' class=comment' if rnd.random() < 0.5 else ''}>" + (f"<b>{self.mark(self.words(2), REST)}</b>" if rnd.random() < 0.5 else "") + p(rnd.randint(3, 70)) + "</div>"
            inner = head + "".join(item() for _ in range(rnd.randint(1, 5)))
        elif kind in ("footer", "header"):
            inner = self.mark(self.stock(kind), REST) if rnd.random() < 0.5 else p(rnd.randint(2, 25))
            if rnd.random() < 0.2:
                inner += f"<h1>{self.mark(self.words(3), REST)}</h1>" if kind == "header" else ""
            if rnd.random() < 0.3:
                inner += self.part("nav")
        else:
            inner = self.mark(self.stock(kind) if rnd.random() < 0.4 else self.words(rnd.randint(3, 40)), REST)
            inner = inner if rnd.random() < 0.5 else f"<p>{inner}</p>"
        return self.wrap(kind, inner)

    def article(self) -> str:
        rnd = self.rnd
        title = self.words(rnd.randint(2, 12))
        out = [f"<{rnd.choice(['h1', 'h1', 'h2'])}>{self.mark(title, MAIN)}</h1>" if rnd.random() < 0.85 else ""]
        out[0] = out[0].replace("</h1>", "</h2>") if out[0].startswith("<h2") else out[0]
        for k in range(1 if rnd.random() < 0.15 else rnd.randint(1, 12 if rnd.random() < 0.8 else 45)):
            kind, text = rnd.random(), self.words(rnd.choice([1, 3, 8, 20, 40, 90, 200]))
            if kind < 0.68:
                body = self.mark(text, MAIN)
                if rnd.random() < 0.2:
                    body = f"<b>{body}"
                    body += "<br>" if rnd.random() < 0.5 else "</b>"
                if rnd.random() < 0.15:
                    body += f' <a href="/x">{html.escape(self.words(3))}</a>'
                out.append(f"<p>{body}" + ("</p>" if rnd.random() < 0.85 else ""))
            elif kind < 0.76:
                out.append(f"<h{k % 3 + 2}>{self.mark(self.words(rnd.randint(1, 7)), MAIN)}</h{k % 3 + 2}>")
            elif kind < 0.85:
                out.append("<ul>" + "".join(f"<li>{self.mark(self.words(rnd.randint(2, 15)), MAIN)}</li>" for _ in range(rnd.randint(2, 5))) + "</ul>")
            elif kind < 0.9:
                out.append(f"<blockquote>{self.mark(text, MAIN)}</blockquote>")
            elif kind < 0.94:
                row = lambda: "<tr>" + "".join(f"<td>{self.mark(self.words(rnd.randint(1, 3)), MAIN)}</td>" for _ in range(3)) + "</tr>"
                out.append("<table>" + row() + row() + "</table>")
            else:
                out.append(f"<div>{self.mark(text, MAIN)}</div>")
            if rnd.random() < 0.06:
                out.append(self.part(rnd.choice(["ad", "form", "sidebar", "notice"])))
        if rnd.random() < 0.12:
            out.append(self.part("comments"))
        return self.wrap("main", "".join(out))

    def page(self) -> str:
        rnd = self.rnd
        before = [k for k, chance in (("notice", 0.3), ("header", 0.4), ("nav", 0.75), ("ad", 0.5), ("sidebar", 0.15), ("form", 0.1)) if rnd.random() < chance]
        after = [k for k, chance in (("comments", 0.3), ("ad", 0.25), ("form", 0.2), ("sidebar", 0.3), ("nav", 0.15), ("footer", 0.75), ("notice", 0.15)) if rnd.random() < chance]
        if rnd.random() < 0.4:
            rnd.shuffle(before)
            rnd.shuffle(after)
        body = "".join(map(self.part, before)) + self.article() + "".join(map(self.part, after))
        if rnd.random() < 0.3:
            body = f'<div class="{rnd.choice(["wrapper", "page", "container", "layout", "x1"])}">{body}</div>'
        return f"<html><head><title>{self.words(4)}</title></head><body>{body}</body></html>"


def labelled(seed: int) -> tuple[list[Leaf], np.ndarray]:
    """Leaves of a generated page and whether each is main text."""
    page, kept, labels = leaves(Writer(random.Random(seed)).page()), [], []
    for leaf in page:
        marks = [c for c in leaf.text if c in MAIN + REST]
        text = leaf.text.replace(MAIN, "").replace(REST, "").strip()
        if text and marks:
            labels.append(marks[0] == MAIN)
            leaf.text = text
            kept.append(leaf)
    return kept, np.array(labels, np.float32)


def batches(pages: list, size: int):
    order = sorted(range(len(pages)), key=lambda i: len(pages[i][1]))
    for at in range(0, len(order), size):
        group = [pages[i] for i in order[at : at + size] if len(pages[i][1])]
        if not group:
            continue
        steps = max(len(y) for _, y in group)
        x, y, live = np.zeros((len(group), steps, DIM), np.float32), np.zeros((len(group), steps), np.float32), np.zeros((len(group), steps), bool)
        for k, (a, b) in enumerate(group):
            x[k, : len(b)], y[k, : len(b)], live[k, : len(b)] = a, b, True
        yield x, y, live


def _sig(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(x, w, u, b, live):
    """As ``blocks.lstm``, keeping what the gradient needs."""
    n, steps, _ = x.shape
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    kept, out, z_in = [], np.zeros((n, steps, HIDDEN), np.float32), x @ w + b
    for t in range(steps):
        z = z_in[:, t] + h @ u
        i, f, o = (_sig(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g, m = np.tanh(z[:, 3 * HIDDEN :]), live[:, t : t + 1]
        fresh = f * c + i * g
        kept.append((h, c, i, f, o, g, np.tanh(fresh), m))
        c, h = np.where(m, fresh, c), np.where(m, o * np.tanh(fresh), h)
        out[:, t] = h
    return out, kept


def _backward(x, u, kept, d_out):
    n, steps, _ = x.shape
    dz_all = np.zeros((n, steps, 4 * HIDDEN), np.float32)
    du, dh, dc = np.zeros_like(u), np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, th, m = kept[t]
        dh = dh + d_out[:, t]
        dh_in, dc_in = dh * m, dc * m
        dcell = dc_in + dh_in * o * (1 - th**2)
        dz = np.concatenate([dcell * g * i * (1 - i), dcell * c * f * (1 - f), dh_in * th * o * (1 - o), dcell * i * (1 - g**2)], 1)
        dz_all[:, t] = dz
        du += h.T @ dz
        dh, dc = dz @ u.T + dh * ~m, dcell * f + dc * ~m
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    return x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(0)


def train(*, pages: int = 4500, epochs: int = 6, seed: int = 1, rate: float = 0.004) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    make = lambda *s: (rng.normal(0, 1 / np.sqrt(s[0]), s)).astype(np.float32)
    w = {"wf": make(DIM, 4 * HIDDEN), "uf": make(HIDDEN, 4 * HIDDEN), "bf": np.zeros(4 * HIDDEN, np.float32)}
    w |= {"wb": make(DIM, 4 * HIDDEN), "ub": make(HIDDEN, 4 * HIDDEN), "bb": np.zeros(4 * HIDDEN, np.float32)}
    w |= {"v": make(2 * HIDDEN), "c": np.zeros(1, np.float32)}
    data = [(vectors(page), y) for page, y in map(labelled, range(pages))]
    first, second, step = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}, 0
    for epoch in range(epochs):
        every, loss = list(batches(data, 24)), 0.0
        rng.shuffle(data)  # other batches in the next epoch
        for b in rng.permutation(len(every)):
            x, y, live = every[b]
            hf, kf = _forward(x, w["wf"], w["uf"], w["bf"], live)
            hb, kb = _forward(x[:, ::-1], w["wb"], w["ub"], w["bb"], live[:, ::-1])
            both = np.concatenate([hf, hb[:, ::-1]], 2)
            p = _sig(both @ w["v"] + w["c"])
            n = live.sum()
            loss += float(-(np.log(np.where(y > 0, p, 1 - p) + 1e-7) * live).sum() / n)
            d = ((p - y) * live / n).astype(np.float32)
            grad = {"v": np.einsum("nth,nt->h", both, d), "c": d.sum(keepdims=True).reshape(1)}
            d_both = d[:, :, None] * w["v"]
            grad["wf"], grad["uf"], grad["bf"] = _backward(x, w["uf"], kf, d_both[:, :, :HIDDEN])
            grad["wb"], grad["ub"], grad["bb"] = _backward(x[:, ::-1], w["ub"], kb, d_both[:, ::-1, HIDDEN:])
            step += 1
            for k, g in grad.items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = w[k] - rate * 0.75**epoch * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        print(f"epoch {epoch}: loss {loss / len(every):.4f}", file=sys.stderr)
    return w


def accuracy(weights: dict[str, np.ndarray], seeds: range) -> float:
    """Share of leaves of generated pages that are labelled right."""
    right = total = 0
    for x, y, live in batches([(vectors(p), y) for p, y in map(labelled, seeds)], 24):
        forward = lstm(x, weights["wf"], weights["uf"], weights["bf"], live)
        backward = lstm(x[:, ::-1], weights["wb"], weights["ub"], weights["bb"], live[:, ::-1])[:, ::-1]
        p = np.concatenate([forward, backward], 2) @ weights["v"] + weights["c"] > 0
        right += int(((p == (y > 0)) & live).sum())
        total += int(live.sum())
    return right / total


if __name__ == "__main__":
    np.savez_compressed(WEIGHTS, **{k: x.astype(np.float16) for k, x in train().items()})
    print("held-out accuracy", accuracy(load_weights(), range(1_000_000, 1_000_500)))
