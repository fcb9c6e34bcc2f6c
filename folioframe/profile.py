"""Everything that names one particular library: pass your own to any operator that prints it."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LibraryProfile:
    name: str = "Example Library"
    place: str = "Example City :"
    marc_org: str = "XxExLib"
    site: str = "https://library.example.org/"
    mail_domain: str = "library.example.org"
    terms_uri: str = "https://library.example.org/terms/"
    terms_prefix: str = "libterms"
    agents_uri: str = "https://library.example.org/agents/"
    licence_uri: str = "https://creativecommons.org/publicdomain/zero/1.0/"
    staff_tag: str = " (Summary by library staff.)"
    mastodon_handle: str = "@library@social.example"
    new_book: str = "Just added to {name}: "
    new_book_short: str = "Just added by {handle}: "
    free_book: str = "{name} gives this book away."
    processed_text: str = "Book #{ebook} is done. Its files are at {name} now.\n"
    critical_text: str = "Book #{ebook} is at {name}, but its log has records that need a look:\n\n{records}\n\nAll of the log: {site}cache/epub/{ebook}/pg{ebook}.converter.log\n"
    files_dir: str = "/srv/library/"
    public_dir: str = "/srv/library"
    cache_dir: str = "/srv/library/cache/epub/"

    def filled(self, template: str) -> str:
        """A template with the library's own name and handle."""
        return template.replace("{name}", self.name).replace("{handle}", self.mastodon_handle)

    def book_url(self) -> str:
        return f"{self.site}ebooks/"


DEFAULT = LibraryProfile()
