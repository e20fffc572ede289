"""Made-up pages with known main text, to train the block labeller on.

A page is a run of regions: its article, and around and inside it menus, headers, footers,
sidebars, notices, adverts, forms, link lists and reader comments. Elements, class names,
nesting and wording are drawn at random; some pages name nothing, so that wording, lengths
and neighbours must tell.
"""

from __future__ import annotations

import random

# Names that sites give to the parts of a page, and words common in them.
NAMED = {
    "article": "article content entry post story text body main prose blog single",
    "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs tabs links toolbar",
    "header": "header masthead banner brand logo top site title tagline",
    "footer": "footer bottom copyright legal colophon imprint foot",
    "sidebar": "sidebar side aside widget related recommended popular trending teaser more",
    "notice": "notice cookie consent alert gdpr message popup modal overlay warning",
    "advert": "ad ads advert advertisement sponsored promo adsense commercial sponsor",
    "form": "form search newsletter login signup subscribe contact field",
    "comments": "comments comment replies reply discussion disqus responses respond feedback",
    "share": "share social sharing follow buttons meta byline tags",
}
WORDING = {
    "menu": "home about contact news products services blog login help sports politics next start",
    "header": "welcome daily official site portal online magazine your source since",
    "footer": "copyright © 2024 all rights reserved privacy policy terms imprint powered by · impressum",
    "sidebar": "related popular most read see also more trending latest recommended articles",
    "notice": "we use cookies to improve your experience accept settings by continuing you agree consent",
    "advert": "advertisement sponsored buy now offer sale discount shop order free shipping today only",
    "form": "search email address password subscribe sign up send name submit your newsletter",
    "comments": "reply said on 3 comments ago i agree thanks great post lol report flag user wrote",
    "share": "share facebook twitter email print tweet pin like follow tags posted by in",
}
HOSTS = {
    "article": "article article article main div div section td",
    "menu": "nav div ul header",
    "header": "header div",
    "footer": "footer div",
    "sidebar": "aside div section",
    "notice": "div section aside p",
    "advert": "div aside section p",
    "form": "form div",
    "comments": "section div ol",
    "share": "div ul p",
}
ONSETS = "b c d f g h j k l m n p r s t v w z ch st tr th pl é ü ñ".split()
RIMES = "a e i o u en er on an in es al or is um ent ion é ß".split()


class Maker:
    """Pages from one seed, as lists of (html, is main text) pieces."""

    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)
        #: What words of a page end in: some pages hold tables or noise.
        self.marks: list[str] = []
        self.named = True
        #: Makes the words of a page its own.
        self.tail = ""

    def word(self) -> str:
        rng = self.rng
        word = "".join(rng.choice(ONSETS) + rng.choice(RIMES) for _ in range(rng.choice((1, 1, 2, 2, 3)))) + self.tail
        return word + rng.choice(self.marks) if self.marks else word

    def sentence(self, low: int, high: int) -> str:
        words = [self.word() for _ in range(self.rng.randint(low, high))]
        words[0] = words[0].capitalize()
        return " ".join(words) + self.rng.choice("....!?")

    def prose(self, low: int, high: int) -> str:
        if self.rng.random() < 0.03:
            return " ".join([self.word().capitalize()] * self.rng.randint(5, 60))
        return " ".join(self.sentence(1, 24) for _ in range(self.rng.randint(low, high)))

    def wording(self, kind: str, low: int, high: int) -> str:
        """Words usual in such a part, or any words: adverts and footers may be prose."""
        rng = self.rng
        usual = WORDING[kind].split()
        if rng.random() < (0.4 if self.named else 0.1):
            return self.prose(1, 3) if kind != "menu" else self.word()
        words = [rng.choice(usual) if rng.random() < 0.7 else self.word() for _ in range(rng.randint(low, high))]
        text = " ".join(words)
        return text.capitalize() if rng.random() < 0.5 else text

    def host(self, kind: str, named: bool) -> tuple[str, str]:
        rng = self.rng
        name = rng.choice(HOSTS[kind].split())
        given = ""
        if named and (name not in ("nav", "article", "main", "footer", "aside") or rng.random() < 0.3):
            usual = rng.choice(NAMED[kind].split())
            extra = rng.choice(["", "", f"-{self.word()}", f" {self.word()}", f"-{rng.choice(['wrap', 'box', 'inner', '1'])}"])
            given = f' {rng.choice(["class", "class", "id"])}="{usual}{extra}"'
        elif rng.random() < 0.4:
            given = f' class="{self.word()}"'
        return f"<{name}{given}>", f"</{name}>"

    def leaf(self, name: str, text: str) -> str:
        if self.rng.random() < 0.25 and " " in text:
            first, rest = text.split(" ", 1)
            tag = self.rng.choice(("b", "i", "em", "strong", "span", "a"))
            kinds = (f"<{tag}>{first}</{tag}> {rest}", f"<{tag}>{first} {rest}</{tag}>", f"<b>{first} {rest}<br>")
            text = self.rng.choice(kinds)
        close = "" if name in ("p", "li") and self.rng.random() < 0.15 else f"</{name}>"
        return f"<{name}>{text}{close}"

    def other(self, kind: str, named: bool) -> list[tuple[str, bool]]:
        rng = self.rng
        begin, end = self.host(kind, named)
        leaves = []
        if kind in ("menu", "share") or kind == "sidebar" and rng.random() < 0.5:
            name = rng.choice(("li", "li", "div", "span", "p"))
            for _ in range(rng.randint(2, 9)):
                text = self.word() if rng.random() < 0.5 else self.wording(kind, 1, 4)
                leaves.append(self.leaf(name, f'<a href="/{self.word()}">{text}</a>'))
            if name == "li" and not begin.startswith(("<ul", "<ol")):
                leaves = ["<ul>", *leaves, "</ul>"]
        elif kind == "comments":
            leaves.append(self.leaf("h3", self.wording(kind, 1, 3)))
            for _ in range(rng.randint(1, 6)):
                inner = rng.choice(("div", "li", "article"))
                label = ' class="comment"' if named or inner == "article" else ""
                leaves.append(f"<{inner}{label}>{self.leaf('p', self.prose(1, 4))}</{inner}>")
        elif kind == "form":
            for _ in range(rng.randint(1, 3)):
                leaves.append(self.leaf(rng.choice(("label", "p", "div", "h4")), self.wording(kind, 1, 6)))
            leaves.append(f'<input type="text"><button>{self.wording(kind, 1, 2)}</button>')
        else:
            bare = rng.random() < 0.5
            for _ in range(rng.choice((1, 1, 2, 3))):
                text = self.wording(kind, 2, 14)
                if kind == "footer" and rng.random() < 0.5:
                    text = f"&copy; {self.word()}.{self.word()}.{rng.choice(('com', 'org', 'net'))} &middot; {text}"
                leaves.append(text if bare else self.leaf(rng.choice(("p", "div", "h3", "h1" if kind == "header" else "p")), text))
                if bare:
                    break
        return [(begin, False), *[(leaf, False) for leaf in leaves], (end, False)]

    def article(self, named: bool) -> list[tuple[str, bool]]:
        rng = self.rng
        begin, end = self.host("article", named)
        inside = [(begin, False)]
        if rng.random() < 0.85:
            inside.append((self.leaf("h1", self.sentence(2, 12)), True))
        for _ in range(rng.choice((1, 2, 3, 5, 8, 12, 20))):
            kind = rng.random()
            if kind < 0.8:
                inside.append((self.leaf("p", self.prose(1, 9)), True))
            elif kind < 0.87:
                inside.append((self.leaf(rng.choice(("h2", "h3")), self.sentence(1, 8)), True))
            elif kind < 0.91:
                items = [self.leaf("li", self.sentence(2, 14)) for _ in range(rng.randint(2, 5))]
                inside += [("<ul>", False), *[(item, True) for item in items], ("</ul>", False)]
            elif kind < 0.94:
                inside.append((f"<blockquote>{self.leaf('p', self.prose(1, 3))}</blockquote>", True))
            else:
                inside += self.other(rng.choice(("advert", "sidebar", "share", "form", "notice")), named or rng.random() < 0.7)
        if rng.random() < 0.15:
            inside += self.other("comments", True)
        return [*inside, (end, False)]

    def page(self) -> list[tuple[str, bool]]:
        rng = self.rng
        named = self.named = rng.random() < 0.8
        self.marks = []
        self.tail = chr(rng.randrange(97, 123)) * rng.randrange(3) + chr(rng.randrange(97, 123))
        if rng.random() < 0.15:
            self.marks = rng.choice([[" |"], ["%%%", "***", "###", "$$$", "&amp;&amp;"], [str(rng.randrange(999))], [";", ":", "=", "{", "}"]])
        before = [k for k in ("notice", "header", "menu", "advert", "form", "sidebar") if rng.random() < 0.45]
        after = [k for k in ("share", "sidebar", "advert", "comments", "form", "menu") if rng.random() < 0.3]
        rng.shuffle(before)
        body = [part for kind in before for part in self.other(kind, named)]
        body += self.article(named)
        body += [part for kind in after for part in self.other(kind, named)]
        if rng.random() < 0.85:
            body += self.other("footer", named)
        if rng.random() < 0.4:
            body = [("<div>", False), *body, ("</div>", False)]
        return [("<html><body>", False), *body, ("</body></html>", False)]
