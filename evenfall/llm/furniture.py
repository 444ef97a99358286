"""Wording of page furniture: navigation, notices, sharing, teasers, footers. Shared by the operators that meet it."""

from __future__ import annotations

import re

# Names of entries in navigation bars and footers, in four languages; one of one word and one of several.
NAV_NAMES = (
    "home start menu search about contact calendar agenda visit tickets shop store basket cart press jobs careers events members membership donate archive news blog faq help login register account venues rentals gallery education imprint privacy terms accessibility sitemap legal newsletter directions program programme subscribe donations shows music education "
    "startseite kontakt anfahrt spielplan programm karten warenkorb suche anmelden vermietung presse mitglieder förderkreis termine veranstaltungen impressum datenschutz agb menü "
    "inicio nosotros contacto entradas tienda buscar alquiler prensa programa socios noticias privacidad calendario "
    "accueil billetterie boutique réservation location confidentialité rechercher panier adhérents programme contactez"
).split()
NAV_PHRASES = (
    "about us, contact us, what’s on, what's on, whats on, visit us, plan your visit, basket (0), cart (0), support us, log in, sign in, sign up, my account, gift cards, hire the hall, our story, our team, summer camp, privacy policy, terms of use, cookie settings, report a problem, back to top, getting here, opening hours, main page, open menu, close menu, older posts, newer posts, "
    "über uns, ueber uns, newsletter abonnieren, mi cuenta, alquiler de sala, cómo llegar, aviso legal, quiénes somos, nous contacter, mentions légales, plan du site"
).split(", ")
NAV_WORDS = frozenset((*NAV_NAMES, *NAV_PHRASES))
# Names on sharing bars.
SHARE_WORDS = frozenset(("facebook", "x", "twitter", "instagram", "whatsapp", "telegram", "pinterest", "linkedin", "email", "e-mail", "mail", "print", "copy link", "post", "share", "reddit", "tumblr", "mastodon", "bluesky", "teilen", "compartir", "partager", "drucken", "imprimir", "add to calendar", "tell your friends", "share this event", "ical export", "google calendar", "outlook", "ical"))
# How furniture lines read, in four languages, in lower case: how they open, and what they hold anywhere.
OPENS = re.compile(
    r"(?:accept|decline|got it|only necessary|save choices)\b.{0,25}$|(?:©|\(c\)|copyright)\s*(?:\d{4}|©)|powered by\b|theme: |site by |views: \d"
    r"|download our app|\d+ comments?\b|follow us\b|folge uns|folgt uns|síguenos|suivez-nous"
    r"|share(?: this event| this)?\s*(?::|$|(?:[fx]\b|facebook|pinterest|whatsapp|telegram|print|copy link|email|twitter))"
    r"|(?:teilen|compartir|partager)\s*(?::|$|\b(?:facebook|pinterest|whatsapp|telegram|print|copy link|email|x\b))|tell your friends"
    r"|(?:related events|most read|popular this week|more events|you (?:may|might) also like|don.t miss|from the calendar|other dates|also at|coming up|weitere termine|otras citas|más eventos|meistgelesen|à voir aussi)\s*(?::|$)"
    r"|(?:related|popular|recommended)\s*(?::|$)|read (?:more|next)\b.{0,4}$|filed under\b|tagged\b|tags: |posted (?:in|by|on)\b|categor(?:y|ies): "
    r"|(?:«|‹|←) |back to (?:all|the|top|this|events)\b|return to (?:all|the|search|this)\b|load more|show more|page \d+ of \d+|older posts|skip to "
    r"|jump to |search results|sponsored|advertisement|anzeige$|publicidad$|\+? ?add to calendar|google calendar|language: "
    r"|(?:en|de|es|fr)(?: ?[|/·•] ?(?:en|de|es|fr))+$|a- a a\+|opening hours\b|leave a (?:comment|reply)|log ?in (?:to|/)|login\b"
    r"|(?:home|start|main page|inicio|startseite|accueil)\s*[>›»/] ?\S|(?:toggle|skip) navigation|close ?[×x]?$|impressum\b|aceptar$|einstellungen$"
    r"|sitemap\b"
)
HOLDS = re.compile(
    r"(?:we|our partners and we|this (?:site|page|website)|run this site|diese (?:website|seite)|usamos|wir (?:setzen|verwenden|nutzen)|ihrer zustimmung|nous utilisons|ce site|guarda pequeños|utilise des)\b.*(?:cookie|text files|tracking tech|dateien|dienste|archivos)"
    r"|your privacy matters|store information on your device|(?:read our )privacy notice|manage consent|cookie settings|accept all|\[accept\]|\[decline\]"
    r"|alle annehmen|\d{4} ©|all rights reserved|all content protected|alle rechte vorbehalten|todos los derechos reservados|tous droits réservés|newsletter"
    r"|mailing list|weekly digest|members.? letter|monthly letter"
    r"|(?:get|join|sign up for|subscribe to|enter your email for) (?:the|our) (?:monthly program|letter)|never miss a show|unsubscribe any time|by email$"
    r"|abonnieren$|suscríbete|boletín|abonnez-vous|previous event|ical export|will not be published|change your mind at any time|no data is sold|back to top"
    r"|nach oben$|report a problem|terms of use|privacy policy|aviso legal|mentions légales"
)
#: Words (or signs) of which every line that OPENS or HOLDS can match has one; a cheap look before the expressions run.
TRIGGERS = frozenset(
    "cookie cookies files technologies tracking dateien dienste archivos privacy privacidad device consent accept decline annehmen got necessary choices c copyright reserved protected vorbehalten reservados réservés powered theme site views download comments comment newsletter mailing digest letter program show unsubscribe email abonnieren suscríbete boletín abonnez follow folge folgt síguenos suivez share teilen compartir partager friends related most popular more also miss calendar dates coming termine citas eventos meistgelesen voir recommended read filed tagged tags posted category categories back return load page previous older skip jump search sponsored advertisement anzeige publicidad add ical google language en de es fr a opening leave published log login home start main inicio startseite accueil mind sold navigation top oben report terms policy aviso impressum légales aceptar einstellungen sitemap data events close".split()
)


_FIRST = re.compile(r"[\s|·•/,–—>›»:]*([^\s|·•/,–—>›»:]+)")
#: First words of the names of entries.
_OPENING = frozenset(w.split()[0] for w in (*NAV_WORDS, *SHARE_WORDS))


#: A line of several sentences is furniture if those that read like it hold at least this share of it.
SHARE = 0.3
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def reads_like(line: str) -> bool:
    """Whether a line has the wording of page furniture, in a good part of its sentences, or is made of menu or sharing entries."""
    low = " ".join(line.lower().split())
    if not ("©" in low or "«" in low or "←" in low or "‹" in low) and TRIGGERS.isdisjoint(re.findall(r"\w+", low)):
        return is_navigation(line)
    parts = _SENTENCE.split(low)
    if len(parts) == 1:
        return _worded(low) or is_navigation(line)
    return sum(len(x) for x in parts if _worded(x)) >= SHARE * len(low) or is_navigation(line)


def _worded(low: str) -> bool:
    return bool(OPENS.match(low) or HOLDS.search(low))


def is_navigation(line: str) -> bool:
    """A line made of the names of menu or sharing entries only."""
    if line.endswith((".", "?")):
        return False
    first = _FIRST.match(line.lower())  # most lines open with a word that opens no entry
    if first is None or first[1] not in _OPENING:
        return False
    low = " ".join(line.lower().split())
    parts = [p for p in re.split(r"\s*[|·•/,–—>›»]\s*|\s{2,}|\n", line.lower().strip()) if p]
    if parts and all((w := " ".join(p.split()).rstrip(":")) in NAV_WORDS or w in SHARE_WORDS for p in parts) and (len(parts) > 1 or parts[0] not in ("x", "post", "music", "shows", "program", "start")):
        return True
    return bool(low) and _covered(re.sub(r"\s*[|·•/]\s*", " ", low))


def _covered(low: str) -> bool:
    """Whether names of entries, joined by single spaces, make up the whole line (two or more of them)."""
    words = low.replace(":", "").split()
    at, n = 0, 0
    while at < len(words):
        for k in (4, 3, 2, 1):
            w = " ".join(words[at : at + k])
            if at + k <= len(words) and (w in NAV_WORDS or w in SHARE_WORDS):
                at, n = at + k, n + 1
                break
        else:
            return False
    return n >= 2
