"""Small labelled URL table: 1 = to be blocked, 0 = to be allowed.

Invented addresses on reserved names; hosts and paths show what spam, piracy,
gambling and tracker addresses look like beside ordinary sites.
"""

from __future__ import annotations

_BLOCKED_HOSTS = """
cheap-meds.example.com cheap-pills-online.example.org buy-pills.example.com pills-express.example.org
discount-pharmacy.example.com best-viagra.example.org spam-links.example.com link-farm.example.org
seo-farm.example.com content-farm.example.org spam-mail.example.com spamfarm.example.org
online-casino.example.com casino-bonus.example.org free-slots.example.com poker-win.example.org
bet-now.example.com quick-loans.example.org payday-cash.example.com easy-money.example.org
adult-cams.example.com xxx-videos.example.org hot-dating.example.com sexy-chat.example.org
free-download-crack.example.com warez-serial.example.org keygen-club.example.com torrent-hub.example.org
replica-watches.example.com fake-bags.example.org miracle-diet.example.com weight-loss-trick.example.org
ads-track.example.com popup-ads.example.org click-track.example.com banner-ads.example.org
cheap-tickets-spam.example.com pills.example.org farm-of-links.example.com crypto-doubler.example.org
""".split()

_ALLOWED_HOSTS = """
news.example.com en.wiki.example.org blog.garden.example.com docs.python.example.org
m.weather.example.com library.example.org www.history.example.com museum.example.org
blog.travel.example.com science.example.org www.school.example.com university.example.org
recipes.example.com kitchen.example.org m.sports.example.com chess.example.org
music.example.com theatre.example.org blog.thinker.example.com physics.example.org
www.therapy.example.com nation.example.org m.station.example.com motion.example.org
health.example.com hospital.example.org blog.writer.example.com poetry.example.org
www.theory.example.com mathematics.example.org city.example.com parliament.example.org
m.nature.example.com ocean.example.org blog.mother.example.com children.example.org
forum.example.com opensource.example.org www.maps.example.com thesaurus.example.org
www.other.example.com tenth.example.org action.example.com thread.example.org
""".split()

_BLOCKED_PATHS = ["/en/buy-now", "/offer/1", "/de/2.html", "/win?ref=x", "/fr/77/", "/cheap/deal.html"]
_ALLOWED_PATHS = ["/en/article", "/about", "/en/31", "/fr/5.html", "/es/120/", "/de/8?page=2"]
_SCHEMES = ["http://", "https://www.", "https://"]


def _table(hosts: list[str], paths: list[str], label: int) -> list[tuple[str, int]]:
    rows = []
    for i, host in enumerate(hosts):
        scheme = _SCHEMES[i % 3] if not host.startswith(("www.", "m.", "blog.")) else "https://"
        # Each host with one path of its kind and one neutral path, so that hosts decide where paths do not.
        rows.append((scheme + host + paths[i % len(paths)], label))
        rows.append((scheme + host + f"/{('en', 'de', 'fr', 'es')[i % 4]}/{17 * i + 3}", label))
    return rows


LABELLED_URLS: list[tuple[str, int]] = _table(_BLOCKED_HOSTS, _BLOCKED_PATHS, 1) + _table(_ALLOWED_HOSTS, _ALLOWED_PATHS, 0)
