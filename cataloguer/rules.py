"""Rule data shared by the jobs.

Everything in the FIXED VALUES block must equal the harvester whose behaviour this
library reproduces, or results differ. They are data, not logic: the Column
expressions in ``cataloguer.functions`` are generated from them.
"""

from __future__ import annotations

# ----------------------------------------------------------------------------
# FIXED VALUES (must match the original harvester exactly; keep order)
# ----------------------------------------------------------------------------

# Station registry, in harvest order: key, repository id, name, url, api base,
# folder, access method.
STATIONS = [
    ("dans_ssh", 5, "DANS SSH (Social Sciences & Humanities)", "https://ssh.datastations.nl",
     "https://ssh.datastations.nl/api", "DANS", "API-CALL"),
    ("dans_archaeology", 5, "DANS Archaeology", "https://archaeology.datastations.nl",
     "https://archaeology.datastations.nl/api", "DANS", "API-CALL"),
    ("dans_lifesciences", 5, "DANS Life & Medical Sciences", "https://lifesciences.datastations.nl",
     "https://lifesciences.datastations.nl/api", "DANS", "API-CALL"),
    ("dans_phys", 5, "DANS Physical & Technical Sciences", "https://phys-techsciences.datastations.nl",
     "https://phys-techsciences.datastations.nl/api", "DANS", "API-CALL"),
    ("uni_halle", 16, "opendata.uni-halle.de (Share_it)", "https://opendata.uni-halle.de",
     None, "opendata", "SCRAPING"),
]

DOWNLOAD_TARGET_BYTES = 50 * 1024 ** 3
PAGE_SIZE = 20
MAX_ATTEMPTS = 3
PROGRESS_SAVE_INTERVAL = 25

SEARCH_TERMS = [
    "qdpx", "nvpx", "atlproj", "MAXQDA", "ATLAS.ti", "NVivo",
    "qualitative research", "qualitative data",
    "interview transcript", "interview study",
    "focus group", "ethnographic", "field notes",
    "oral history", "thematic analysis",
    "grounded theory", "qualitative data analysis", "QDA",
]

QDA_EXTENSIONS = [
    "qdpx", "nvpx", "nvp", "atlproj", "atl",
    "mx", "mx24", "mx20", "mx18", "mxd",
    "qda", "f4a", "f4p", "quirkos",
]

COMPANION_EXTENSIONS = [
    "pdf", "txt", "rtf", "docx", "doc", "odt",
    "xlsx", "xls", "csv",
    "mp3", "wav", "m4a", "aac", "ogg", "flac",
    "mp4", "mov", "avi", "mkv", "wmv",
    "jpg", "jpeg", "png", "tiff", "tif", "bmp",
    "zip", "tar", "gz", "7z",
]

# OAI text hints (lower case, plain substrings).
QDA_HINTS = [
    "qdpx", "nvpx", "atlproj", "maxqda", "atlas.ti",
    "nvivo", "qualitative data", "qda", "qualitative research",
    "interview", "thematic analysis",
]

# Item-page link regex and the path substrings that mark thumbnails/previews.
BITSTREAM_LINK_RE = r'href="(/bitstream/[^"?]+)"'
LINK_SKIP_PATTERNS = ["/thumbnail", "/preview", ".gif", "_thumb", "isAllowed=n", "format=jpg"]

PLACEHOLDER_FILE_NAME = "no_files_found.txt"
PLACEHOLDER_FILE_TYPE = "txt"

# Person roles.
VALID_ROLES = ["AUTHOR", "UPLOADER", "OWNER", "OTHER", "UNKNOWN"]
ROLE_SYNONYMS = [
    ("CREATOR", "AUTHOR"),
    ("PI", "AUTHOR"),
    ("PRINCIPAL_INVESTIGATOR", "AUTHOR"),
    ("RESEARCHER", "AUTHOR"),
    ("DEPOSITOR", "UPLOADER"),
    ("SUBMITTER", "UPLOADER"),
    ("DATA_MANAGER", "OWNER"),
    ("MANAGER", "OWNER"),
    ("CONTRIBUTOR", "OTHER"),
    ("EDITOR", "OTHER"),
    ("CONTACT", "OTHER"),
    ("DISTRIBUTOR", "OTHER"),
    ("FUNDER", "OTHER"),
    ("SPONSOR", "OTHER"),
    ("SUPERVISOR", "OTHER"),
    ("TRANSLATOR", "OTHER"),
    ("PRODUCER", "OTHER"),
    ("PUBLISHER", "OTHER"),
    ("PROJECT_MEMBER", "OTHER"),
    ("RELATED_PERSON", "OTHER"),
]

# Licence labels, tried in this order on the lower-cased, '/'-right-stripped, trimmed
# value. Kinds: "contains" = substring, "prefix" = starts with.
LICENSE_URL_RULES = [
    ("creativecommons.org/publicdomain/zero/1.0", "CC0-1.0"),
    ("creativecommons.org/publicdomain/mark/1.0", "Public Domain Mark 1.0"),
    ("creativecommons.org/licenses/by/4.0", "CC-BY-4.0"),
    ("creativecommons.org/licenses/by/3.0", "CC-BY-3.0"),
    ("creativecommons.org/licenses/by/2.5", "CC-BY-2.5"),
    ("creativecommons.org/licenses/by/2.0", "CC-BY-2.0"),
    ("creativecommons.org/licenses/by/1.0", "CC-BY-1.0"),
    ("creativecommons.org/licenses/by-sa/4.0", "CC-BY-SA-4.0"),
    ("creativecommons.org/licenses/by-sa/3.0", "CC-BY-SA-3.0"),
    ("creativecommons.org/licenses/by-sa/2.5", "CC-BY-SA-2.5"),
    ("creativecommons.org/licenses/by-nd/4.0", "CC-BY-ND-4.0"),
    ("creativecommons.org/licenses/by-nd/3.0", "CC-BY-ND-3.0"),
    ("creativecommons.org/licenses/by-nc/4.0", "CC-BY-NC-4.0"),
    ("creativecommons.org/licenses/by-nc/3.0", "CC-BY-NC-3.0"),
    ("creativecommons.org/licenses/by-nc-sa/4.0", "CC-BY-NC-SA-4.0"),
    ("creativecommons.org/licenses/by-nc-sa/3.0", "CC-BY-NC-SA-3.0"),
    ("creativecommons.org/licenses/by-nc-nd/4.0", "CC-BY-NC-ND-4.0"),
    ("creativecommons.org/licenses/by-nc-nd/3.0", "CC-BY-NC-ND-3.0"),
    ("rightsstatements.org/vocab/InC/1.0", "InC-1.0"),
]
LICENSE_DANS_RULES = [
    ("dans licence", "DANS Licence"),
    ("dans license", "DANS Licence"),
    ("dare", "DARE"),
    ("open access for registered", "DANS Open Access (Registered)"),
    ("restricted access", "Restricted Access"),
    ("geen", "No Licence Specified"),
]
LICENSE_SHORT_RULES = [
    ("cc0", "CC0-1.0"),
    ("cc-0", "CC0-1.0"),
    ("cc by 4.0", "CC-BY-4.0"),
    ("cc by 3.0", "CC-BY-3.0"),
    ("cc by-sa 4.0", "CC-BY-SA-4.0"),
    ("cc by-sa 3.0", "CC-BY-SA-3.0"),
    ("cc by-nd 4.0", "CC-BY-ND-4.0"),
    ("cc by-nc 4.0", "CC-BY-NC-4.0"),
    ("cc by-nc-sa 4.0", "CC-BY-NC-SA-4.0"),
    ("cc by-nc-nd 4.0", "CC-BY-NC-ND-4.0"),
]
LICENSE_OTHER_RULES = [
    ("opensource.org/licenses/mit", "MIT"),
    ("opensource.org/licenses/apache", "Apache-2.0"),
    ("apache.org/licenses/license-2.0", "Apache-2.0"),
    ("gnu.org/licenses/gpl-3", "GPL-3.0"),
    ("gnu.org/licenses/gpl-2", "GPL-2.0"),
    ("gnu.org/licenses/lgpl", "LGPL"),
    ("opensource.org/licenses/bsd", "BSD"),
    ("eupl", "EUPL-1.2"),
    ("pddl", "PDDL"),
    ("odbl", "ODbL"),
    ("odc-by", "ODC-By"),
]
# A value that already looks like an SPDX id is kept as it is.
SPDX_LIKE_RE = r"^[A-Z0-9][A-Z0-9\.\-]+$"

SIZE_UNITS = ["B", "KB", "MB", "GB", "TB"]
SIZE_UNIT_LAST = "PB"

# File statuses.
SUCCESS, FAILED, RESTRICTED, SKIPPED = "SUCCESS", "FAILED", "RESTRICTED", "SKIPPED"

OAI_QUERY_STRING = "OAI-PMH full harvest"

# ----------------------------------------------------------------------------
# end of FIXED VALUES
# ----------------------------------------------------------------------------


def license_rules() -> list[tuple[str, str, str]]:
    """All licence rules as (kind, pattern, label) in evaluation order."""
    rules = [("contains", p, lab) for p, lab in LICENSE_URL_RULES]
    rules += [("contains", p, lab) for p, lab in LICENSE_DANS_RULES]
    rules += [("prefix", p, lab) for p, lab in LICENSE_SHORT_RULES]
    rules += [("contains", p, lab) for p, lab in LICENSE_OTHER_RULES]
    return rules


def role_map() -> dict[str, str]:
    out = {r: r for r in VALID_ROLES}
    out.update(dict(ROLE_SYNONYMS))
    return out
