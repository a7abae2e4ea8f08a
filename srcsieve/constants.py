"""These must equal the published collection rules for right results."""

# Event kinds that name an active repository.
EVENT_TYPES = ("PushEvent", "CreateEvent")

# Repository bounds.
MIN_STARS = 50
MIN_SIZE_KB = 50_000
MAX_SIZE_KB = 1_000_000
REPOS_PER_FILE = 10

# Folder names that hide a file wherever they occur in its path.
IGNORED_DIRS = (".git", "node_modules", "__pycache__", "venv", ".idea")

# Quality bounds.
MIN_LINES = 5
MAX_LINES = 10_000
MIN_ALPHA_RATIO = 0.25
XML_PREFIX_CHARS = 100
MIN_VISIBLE_RATIO = 0.2
MIN_VISIBLE_CHARS = 100
MIN_CHARS_PER_TOKEN = 2.5

# Near-duplicate detection.
DOC_ID_PREFIX = "doc_prefix"
CHAR_NGRAMS = 24
NUM_BANDS = 20
HASHES_PER_BAND = 13
MINHASH_SEED = 42

NOTEBOOK_LANGUAGE = "Jupyter Notebook"
UNKNOWN_LANGUAGE = "Unknown"

MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)

# File extensions left out of the corpus.
EXCLUDED_EXTENSIONS = (
    ".al", ".as", ".asc", ".aj", ".bison", ".bpl",
    ".ck", ".project", ".lisp", ".l", ".sexp", ".cwl", ".conll", ".conllu", ".cue",
    ".w", ".desktop", ".in", ".service", ".com", ".edn",
    ".lock", ".factor", ".g", ".gd", ".pot", ".gitmodules", ".geo",
    ".bdf", ".gn", ".dockerignore", ".eslintignore", ".gitignore", ".npmignore",
    ".cfg", ".prefs", ".url", ".mf", ".properties", ".snap", ".mps",
    ".jsonld", ".ls", ".d", ".make", ".cdf", ".nb", ".ms", ".mrc", ".inc", ".nc",
    ".njk", ".p", ".dpr", ".pp", ".ph", ".pck", ".pls", ".tps", ".trg", ".vw", ".pbt",
    ".pb", ".rkt", ".rktd", ".res", ".rest", ".rtf",
    ".1", ".1d", ".2", ".3d", ".4", ".5", ".6", ".7", ".8", ".9", ".man",
    ".sc", ".tst", ".te", ".env", ".sl", ".cocci", ".tab", ".sig",
    ".ihlp", ".sthlp", ".i", ".aux", ".ltx", ".toc", ".ttl", ".frm", ".frx", ".snippet",
    ".mtl", ".wikitext", ".reg", ".xbm", ".kml", ".pt", ".resx",
    ".rss", ".plist", ".tmcommand", ".tmlanguage", ".tmsnippet", ".tmtheme", ".yy",
    ".txt", ".md", ".st",
)

# Languages left out of the corpus.
EXCLUDED_LANGUAGES = (
    "2-Dimensional Array", "AGS Script", "Bicep", "Checksums", "COLLADA", "CSV", "Diff", "DirectX 3D File", "E-mail",
    "G-code", "Gerber Image", "Git Revision List", "Gnuplot", "Go", "IRC log", "KiCad Layout",
    "KiCad Schematic", "Lasso", "Linus", "Kernel Module", "Max", "Microsoft Developer Studio Project",
    "Microsoft Developer Studio Solution",
    "Pickle", "PostScript", "POV-Ray SDL", "Public Key", "Pure Data", "Raw token data", "robots.txt", "STL",
    "SubRip Text", "SVG", "TSV",
    "Unity3D Asset", "Wavefront Object", "WebVTT", "X PixMap",
)

# Media types added by hand to those a lexer registry gives.
EXTRA_MIME_TYPES = {
    "shell": "text/x-sh",
    "r": "text/x-r",
    "objective c": "text/x-objectivec",
    "objective c++": "text/x-objectivec++",
    "fsharp": "text/x-fsharp",
    "lisp": "text/x-common-lisp",
}
