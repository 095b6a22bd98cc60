"""Dictionaries, word lists, labels and patterns, as data.

Everything in the block below is a FIXED VALUE: it must equal the source
system's values for the outputs to match. Values are listed in their natural
order. Operators take these as defaults and accept replacements.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the source system's; do not edit)
# ---------------------------------------------------------------------------

# Content block types used to route blocks to staging tables.
BLOCK_REQUIREMENTS = "requisito_tramite"
BLOCK_STEPS = "pasos_del_tramite"
BLOCK_COSTS = "costo_del_tramite"
BLOCK_PARAGRAPH = "paragraph"
NORMS_TITLE_WORD = "normativa"
PARTICIPANTS_SUBTITLE = "Participantes y Profesionales responsables"
APPOINTMENT_KEYWORD = "turno"
IN_PERSON_MODALITY = "21717"

# Participants: words that disqualify a list item from being a role.
PARTICIPANT_BLACKLIST = [
    "escritura", "acta", "permiso", "constancia", "informe", "certificado",
    "partida", "plano", "reglamento", "contrato", "estatuto", "nota",
    "si el", "en caso", "cuando", "donde", "para el", "baldío", "obra nueva",
    "título", "boleta", "frente", "dorso",
]
# Connector words trimmed once from the end, then once from the start, of a role.
ROLE_CONNECTORS = ["o", "y", "del", "para", "un", "una", "el", "la", "los", "las", "de", "en", "por"]
# Roles every procedure has.
DEFAULT_ROLES = ["Ciudadano / Particular", "Empresa / Organización", "Profesional Matriculado"]
# Characters stripped from both ends of a list item, then of a role.
ITEM_EDGE_CHARS = " .,;:-_"
ROLE_EDGE_CHARS = " .,;:"
# Longest item that is still split on commas into several roles; role length bounds.
ROLE_SPLIT_MAX_LEN = 60
ROLE_MIN_LEN = 3
ROLE_MAX_LEN = 50

# Payment methods: label -> pattern over folded (accent-free, lower-case) text.
PAYMENT_PATTERNS = [
    ("Pago Fácil", r"\bpago\s*facil\b"),
    ("Rapipago", r"\brapipago\b"),
    ("Banco Ciudad", r"\bbanco\s*ciudad\b"),
    ("Banco Provincia", r"\bbanco\s*provincia\b"),
    ("Mercado Pago", r"\bmercado\s*pago\b"),
    ("Pago mis cuentas", r"\bpago\s*mis\s*cuentas\b"),
    ("Bapro Pagos", r"\bbapro\s*pagos\b"),
    ("Provincia Net", r"\bprovincia\s*net\b"),
    ("Visa", r"\bvisa\b"),
    ("MasterCard", r"\bmaster\s*card\b"),
    ("Cabal", r"\bcabal\b"),
    ("American Express", r"\bamerican\s*express\b"),
    ("ATM", r"\batm[s]?\b"),
    ("Página web", r"\bpagina\s*web\b"),
    ("BUEPP", r"\bbuepp\b"),
]

# Platforms: name -> host pattern; the first match wins.
PLATFORM_PATTERNS = [
    ("TAD", r"tad\.buenosaires\.gob\.ar"),
    ("SIGECI", r"formulario-sigeci\.buenosaires\.gob\.ar"),
    ("AGControl", r"atencionvirtual\.agcontrol\.gob\.ar"),
    ("miBA", r"login\.buenosaires\.gob\.ar/auth"),
    ("AGIP", r"agip\.gob\.ar"),
    ("AFIP", r"afip\.gob\.ar"),
]
PLATFORM_EXCLUDED_HOST = "mapa.buenosaires.gob.ar"
PLATFORM_FILE_EXTENSIONS = ["pdf", "zip", "doc", "docx", "jpg", "png", "dwg"]
PLATFORM_WEB = "Plataforma Web"

# Documents: headings that introduce a list, and link texts that name nothing.
DOC_OBLIGATORY_HEADING = "Documentación obligatoria"
DOC_OPTIONAL_HEADING = "Documentación opcional"
DOC_GENERIC_PHRASES = [
    "Documentación a presentar", "Documentos requeridos",
    "Documentación requerida", "Documentos a adjuntar",
]
GENERIC_LINK_TEXTS = [
    "AQUÍ", "AQUI", "ACA", "ACÁ", "DESCARGAR", "DESCARGA", "VER",
    "LINK", "CLIC", "CLICK", "INGRESANDO", "MODELO", "PLANILLA", "SITIO WEB",
]
GENERIC_LINK_MIN_LEN = 4
DOC_TYPE_OBLIGATORY = "Obligatoria"
DOC_TYPE_OPTIONAL = "Opcional"
# Leading connector words dropped once from a document title.
TITLE_CONNECTORS = [
    "y", "o", "e", "u", "donde", "que", "el", "la", "los", "las",
    "un", "una", "del", "de", "por", "para", "con",
]
TITLE_MIN_LEN = 3
DOC_DESC_EDGE_CHARS = " .,;:-_()"

# Requirements: words that mark a legal person, words that mark an optional item.
LEGAL_PERSON_WORDS = ["juridica", "empresa", "sociedad", "apoderado"]
OPTIONAL_WORDS = ["opcional", "si corresponde"]
OPTIONAL_SUBTITLE_WORD = "opcional"
REQUIREMENT_SUBGROUP = "GENERAL"
REQUIREMENT_MIN_LEN = 4          # kept when longer than 3 characters
PARAGRAPH_REQUIREMENT_MIN_LEN = 6  # paragraphs kept when longer than 5 characters
PARAGRAPH_EXCLUDED_WORD = "miba"

# Level of the digital identity required: highest digit after this word.
LEVEL_KEYWORD = "nivel"

# Organisations.
ORG_NAME_WORD = "organismo"
ORG_ADDRESS_WORDS = ["ubicación", "dirección"]
ORG_ADDRESS_LABEL = r"^(Dirección|Ubicación)"
ORG_STREET_PATTERN = (
    r"((Av\.|Avenida|Calle|Cnel\.)\s|Uspallata\s|Bolívar\s|Lima\s|Viamonte\s|"
    r"Defensa\s|Piedra\sBuena|Corrientes\s)"
)
ORG_HOURS_WORDS = ["horario", "días de atención"]
ORG_HOURS_LABEL = r"^(Días de atención|Horarios de atención|Horario)"
ORG_HOURS_FALLBACK = r"(D[ií]as?.*(horario[s]?|atenci[oó]n).*?:?\s*)([^\n<]+)"
ORG_MINISTRY_WORD = "ministerio"
PHONE_PATTERN = (
    r"(?:(?:Tel[eé]fono|Contacto|llamar(?: al)?|comunicate(?: al)?)\D{0,40}?)"
    r"(\d{4,5}[- ]?\d{3,4})"
)
MAIL_PATTERN = r"[\w\.-]+@[\w\.-]+\.\w+"
NOT_SPECIFIED = "No especificado"

# Consume-layer labels and defaults.
ROLE_PREFIX = "Rol: "
PERSON_ROLE_PATTERN = "ciudadano|propietario|inquilino|profesional|tercero|visualizador"
PROFESSIONAL_ROLE_PATTERN = "profesional|profesional matriculado"
STEP_TITLE_DEFAULT = "Paso del Trámite"
STEP_TEXT_DEFAULT = "Sin descripción"
STEP_SHOW_DEFAULT = "S"
PLATFORM_PREFIX = "Plataforma: "
PLATFORM_WEB_MODALITY = "Web/Online"
IN_PERSON_MEMBER = ("Presencial", None, "Presencial", "Trámite presencial")
PAYMENT_DESCRIPTION = "Medio de pago habilitado"
COST_DEFAULT_CONCEPT = "General"
TARIFF_LAW_MARKER = "Se encontró Ley Tarifaria"
PURPOSE_DEFAULT = "Sin finalidad"
DEPENDENCY_DEFAULT = "0"
PROCEDURE_TYPE_DEFAULT = "1"
AUDIT_FORMAT = "yyyy-MM-dd HH:mm:ss"

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

# Our repair of the tariff-law test (the source matched a literal "%20").
TARIFF_LAW_PATTERN = r"ley(\s|%20)+tarifaria"

# Characters Python's str.isspace() accepts, as one regex class body usable in
# both Java regex and RE2 (so Spark and DuckDB oracles agree with Python).
WS_CLASS = (
    r"\t\n\x{0b}\f\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = "[" + WS_CLASS + "]"
# The same characters as a plain set (for trimming), derived from Python itself.
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
