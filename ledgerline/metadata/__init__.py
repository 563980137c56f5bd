"""Metadata discovery, one function per kind of source; each returns objects, fields and links."""

from ledgerline.metadata import dictionary, flat_catalogue, json_catalogue, suite_catalogue, system_catalogue

DISCOVERY = {
    "dictionary": dictionary.discover,
    "system_catalogue": system_catalogue.discover,
    "suite_catalogue": suite_catalogue.discover,
    "flat_catalogue": flat_catalogue.discover,
    "commented_catalogue": flat_catalogue.discover_commented,
    "json_catalogue": json_catalogue.discover,
    "historian": flat_catalogue.discover_historian,
}
