"""Pages for tests, built from fields: every builder puts the fields where the selectors look, in a frame of its own."""

from html import escape

BASE = "https://baca.komikraya.example"


def tag(name, *inside, **attrs):
    told = "".join(f' {k.rstrip("_").replace("_", "-")}="{escape(str(v))}"' for k, v in attrs.items())
    return f"<{name}{told}>" if name in ("img", "br", "hr") else f"<{name}{told}>{''.join(inside)}</{name}>"


def frame(*inside):
    """A whole page around some parts: what it has besides must not count."""
    menu = tag("nav", *(tag("a", word, href=f"/menu/{word}") for word in ("beranda", "bantuan")))
    return f"<!doctype html>{tag('html', tag('head', tag('title', 'x'), tag('script', 'let a = `<h1 class=titless>no</h1>`;')), tag('body', menu, *inside, tag('footer', 'habis')))}"


def detail_page(title, *, kind=None, image=None, rating=None, info=(), genres=(), synopsis=None, chapters=(), similar=()):
    """Chapters are (address, text); info are (label, value); similar are (slug, name)."""
    parts = [tag("h1", escape(title), class_="titless")]
    if chapters:
        parts.append(tag("div", *(tag("p", tag("span", tag("a", text, href=url), class_="lchx")) for url, text in chapters), class_="bxcl"))
    if kind:
        parts.append(tag("span", kind, class_=f"typeflag {kind}"))
    if rating:
        parts.append(tag("div", tag("i", rating), tag("small", "dari 10"), class_="infoanime-rating"))
    if image:
        parts.append(tag("div", tag("img", src=image), class_="infoanime"))
    spans = [tag("span", tag("b", f"{label}:"), " ", value) for label, value in info]
    parts.append(tag("div", *(tag("a", g, rel="tag", href=f"/jenis/{n}") for n, g in enumerate(genres)), *spans, class_="spe"))
    if synopsis:
        parts.append(tag("section", tag("div", synopsis, class_="entry-content entry-content-single"), id="sinopsis"))
    parts.append(tag("div", tag("ol", *(tag("li", tag("a", "lihat", class_="series", href=f"/komik/{s}/"), *([tag("h3", tag("a", name, class_="series", href=f"/komik/{s}/"))] if name else [])) for s, name in similar)), id="mirip"))
    return frame(*parts)


def list_page(*addresses):
    return frame(tag("div", *(tag("p", tag("a", f"no. {n}", class_="tip", href=a)) for n, a in enumerate(addresses)), class_="listupd"))


def reader_page(*images):
    return frame(tag("div", *(tag("img", src=i) + tag("br") for i in images), id="chimg-auh"))


def home_page(*cards):
    """Cards are (slug, name, chapter address, kind, image, whether the name has a heading)."""

    def card(slug, name, chapter=None, kind=None, image=None, headed=True):
        link = tag("a", name, href=f"/komik/{slug}/")
        more = [tag("p", tag("a", "baru", href=chapter)) if chapter else "", tag("span", class_=f"typeflag {kind}") if kind else "", tag("div", tag("img", src=image), class_="limit") if image else ""]
        return tag("div", tag("h3", link) if headed else link, *more, class_="animepost")

    return frame(tag("div", *(card(*c) for c in cards), class_="listupd"))


def feed_page(*cards):
    """Cards are (slug, name, chapter address, age, whether the name has a heading)."""

    def card(slug, name, chapter=None, age=None, headed=True):
        link = tag("h3", tag("a", name, href=f"/komik/{slug}/")) if headed else tag("a", name, class_="animposx", href=f"/komik/{slug}/")
        return tag("div", tag("div", tag("a", "baca", href=chapter), tag("span", age, class_="datech") if age else "", class_="lsch") if chapter else "", link, class_="animepost")

    return frame(*(card(*c) for c in cards))


LIST = list_page(f"{BASE}/komik/satu/", "/komik/dua", "/komik/satu/", "/lain/tiga/", "/komik/tiga/?x")
DETAIL = detail_page(
    "Komik Menara & Kabut", kind="Manhwa", image="https://cdn.komikraya.example/data/wp-content/uploads/Komik-menara-300x400.jpg", rating="8.5",
    info=[("Alternatif", "Tower - Mist"), ("Ilustrator", "Budi"), ("Pengarang", "Sari Dewi"), ("Status", "Berjalan"), ("Genre", "Laga, Misteri")], genres=["Laga", "Misteri"],
    synopsis="<p>Update chapter terbaru komik Menara bahasa. Sinopsis Menara itu tinggi <b>sekali</b>",
    chapters=[("/menara-chapter-1/", "Chapter 1"), (f"{BASE}/menara-chapter-10/", "Chapter 10"), ("/menara-chapter-2-5/", "Chapter 2.5"), ("/menara-chapter-1/", "Chapter 1")],
    similar=[("kabut", "Kabut"), ("kabut", None)],
)
READER = reader_page(
    "https://img.komikraya.example/data/menara/10/001.jpg", "https://img.komikraya.example/data/menara/10/002.webp", "https://cdn.komikraya.example/data/menara/10/003",
    "https://img.komikraya.example/data/logo.png", "https://else.example/data/x.png",
)
HOME = home_page(("satu", "Satu", "/satu-chapter-7-5/", "Manga", "/a.jpg"), ("satu", "Lagi"), ("dua", "Dua", None, None, None, False))
FEED = feed_page(("satu", "Satu", "/satu-chapter-12/", "5 menit lalu"), ("dua", "Dua", "dua-chapter-3.5", "2 Jam lalu", False), ("tiga", "Tiga"), ("tiga", "Tiga", "/tiga-chapter-1/"))
