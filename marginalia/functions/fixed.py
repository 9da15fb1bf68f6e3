"""Labels, word lists and formats that decide results.

Everything in this module is data. The values must stay exactly as they are for
results to agree between runs and with stored artifacts.
"""

# --- fixed values: accent folding for slugs -------------------------------
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ"
UNACCENTED = "aaaaaaceeeeiiiinoooooouuuuyy"

# --- fixed values: language labels (lower case) to locale -------------------
LOCALE_LABELS = {
    "english": "en",
    "portuguese": "pt",
    "spanish": "es",
    "pt-br": "pt",
    "es - automated": "es",
    "pt - automated": "pt",
    "es": "es",
    "en": "en",
    "pt": "pt",
}
DEFAULT_LOCALE = "en"
PREFIXED_LOCALES = ("es", "pt")

# --- fixed values: editorial status labels (lower case) ---------------------
STATUS_LABELS = {
    "active": [
        "ready to publish",
        "adding to staging site",
        "draft published",
        "published",
    ],
    "draft": [
        "not started",
        "update in progress",
        "ready for translation",
        "automated translation in progress",
        "automated translations generated",
        "auto translation generated",
        "reviewing translations",
    ],
    "deprecated": ["remove"],
    "archived": ["unplublished", "unpublished"],
}
# --- fixed values: patterns for labels outside the list, tried in this order --
STATUS_PATTERNS = [
    ("archived", "deleted|inaccessible|unpl?ublished"),
    ("deprecated", "depreciated|deprecated|archive|remove"),
    ("active", "done|validated|pre-publish|published|ready to publish|ready-to-publish"),
]
DEAD_LABELS = ("Remove", "Unplublished")
DEAD_STATUSES = ("deprecated", "archived")
STATUSES = ("active", "draft", "deprecated", "archived")
LANGUAGE_SOURCES = ("explicit", "automated", "fallback")

# --- fixed values: sections --------------------------------------------------
UNCATEGORIZED = "Uncategorized"
UNCATEGORIZED_ORDER = 9999
MISSING_ORDER = 99999
SECTION_PREFIX = r"^\d+[+-]\s*(?:-\s*)?"

# --- fixed values: section label translations --------------------------------
SECTION_LABELS = {
    "pt": {
        "Uncategorized": "Sem Categoria",
        "Overview": "Visão Geral",
        "Gathering Observations & Tracks": "Coletando Observações e Trilhas",
        "Reviewing Observations & Tracks": "Revisando Observações e Trilhas",
        "Exchanging Observations": "Trocando Observações",
        "Managing Data and Privacy": "Gestão de Privacidade e Segurança de Dados",
        "Managing Data Privacy and Security": "Gestão de Privacidade de Dados e Segurança",
        "Managing Projects": "Gerenciando Projetos",
        "Sharing and Exporting different data types": "Compartilhando e Exportando Diferentes Tipos de Dados",
        "Troubleshooting": "Solução de Problemas",
        "Using Exchange Over the Internet": "Usando Exchange pela Internet",
        "Miscellaneous": "Variado",
        "Ending a project": "Encerrando um Projeto",
    },
    "es": {
        "Uncategorized": "Sin Categoría",
        "Overview": "Vista General",
        "Gathering Observations & Tracks": "Registrando Observaciones y Trayectos",
        "Reviewing Observations & Tracks": "Revisando Observaciones y Trayectos",
        "Exchanging Observations": "Intercambiando Observaciones",
        "Managing Data and Privacy": "Gestión de Privacidad y Seguridad de Datos",
        "Managing Data Privacy and Security": "Gestión de Privacidad de Datos y Seguridad",
        "Managing Projects": "Gestión de Proyectos",
        "Sharing and Exporting different data types": "Compartir y Exportar Diferentes Tipos de Datos",
        "Troubleshooting": "Solución de Problemas",
        "Using Exchange Over the Internet": "Usando Exchange por Internet",
        "Miscellaneous": "Misceláneas",
        "Ending a project": "Finalizar un Proyecto",
    },
}

# --- fixed values: title patterns ---------------------------------------------
# Word ends are ASCII ones here: a letter with an accent ends the word before it.
TEST_TITLE = r"(?i)^\s*[\[(]?\s*(testing|test|teste|prueba)(?![A-Za-z0-9_])"
AUTOMATED = r"(?i)(?<![A-Za-z0-9_])automated(?![A-Za-z0-9_])"
INTERNAL_TITLE = r"(?i)^\s*(new element|process checklist)\s*$"
INTERNAL_MARKER = r"(?i)\[\s*(add content here|en title|insert content here)\s*\]"
INTERNAL_NOTE = r"(?i)\((translating|translation|for translation|staging|do not publish|internal)[^)]*\)"
STAGING_TITLE = r"(?i)[-_]\d{4}-\d{2}-\d{2}\s*translation"

# --- fixed values: property names ------------------------------------------------
TITLE_PROPERTIES = ("Content elements", "Name", "title", "Title")
DEFAULT_KEYWORDS = ("docs",)

# --- fixed values: body markers ---------------------------------------------------
STUB_MARKER = r"(?i)\[\s*(insert|add)\s+content\s+here\s*\]"
SPACER = r'<div class="notion-spacer"[^>]*></div>'
EMPTY_BODY_NOTICE = (
    ":::note\nContent coming soon — this page has no content in Notion yet.\n:::"
)

# --- fixed values: assets -------------------------------------------------------
ASSET_HOSTS = (
    "amazonaws.com",
    "notion.so",
    "secure.notion-static.com",
    "prod-files-secure.s3.us-west-2.amazonaws.com",
)
MIME_EXTENSIONS = {
    "image/png": ".png",
    "image/jpeg": ".jpg",
    "image/gif": ".gif",
    "image/webp": ".webp",
    "image/svg+xml": ".svg",
}
DEFAULT_EXTENSION = ".png"
STATIC_IMAGE_PREFIX = "/images/notion/"

# --- fixed values: links ----------------------------------------------------------
SOURCE_HOST = r"(?i)^https?://(www\.)?notion\.so"
EDIT_URL = "https://www.notion.so/"
SOURCE_URL = "https://notion.so/"

# --- fixed values: block types with a rendering -----------------------------------
SUPPORTED_BLOCKS = (
    "paragraph", "heading_1", "heading_2", "heading_3", "bulleted_list_item",
    "numbered_list_item", "to_do", "toggle", "quote", "callout", "code", "image",
    "video", "file", "table", "table_row", "divider", "bookmark", "link_preview",
    "child_page", "unsupported", "child_database", "link_to_page", "synced_block",
    "ai_block", "column_list", "column", "table_of_contents", "embed", "pdf",
    "equation", "breadcrumb",
)

# --- fixed values: retry policy -----------------------------------------------------
RETRYABLE = ("network", "timeout", "rate_limit", "http_5xx")

# --- fixed values: white space of every kind, non-breaking and wide blanks included ---
SPACE = (
    " \t\n\x0b\x0c\r\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# --- fixed values: chunk sizes in estimated tokens ------------------------------------
CHUNK_MIN = 400
CHUNK_MAX = 800
CHUNK_MERGE_MAX = 960
OVERLAP_TARGET = 100
OVERLAP_FLOOR = 80
OVERLAP_MAX = 120

# --- fixed values: image slots of a body ----------------------------------------------
# A note that stands for an image lost in translation, and an image that is there.
LOST_IMAGE = r":::note 🖼️\n(?:static/images/[^\n]+|\[[^\]\n]+\])\n\n:::"
STORED_IMAGE = r"!\[[^\]]*\]\(assets/[^)]+\)"
LOST_IMAGE_START = ":::note 🖼️"
