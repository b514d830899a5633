"""Values a mapping relies on that must stay exactly as written.

Fixed values: these names, words and markers are part of how a mapping sheet
is read and what a loaded target looks like, so they must match the source
tool's conventions exactly.  They are stated here once, in natural order.
"""

# The seven audit column names of a target table, in layout order.
AUDIT_COLUMNS = ("DATA_SRC", "CREATE_DT", "CREATE_BY", "CREATE_PGM", "UPDATE_DT", "UPDATE_BY", "UPDATE_PGM")

# Audit columns holding a time, a user, and a program name.
AUDIT_TIME_COLUMNS = ("CREATE_DT", "UPDATE_DT")
AUDIT_USER_COLUMNS = ("CREATE_BY", "UPDATE_BY")
AUDIT_PGM_COLUMNS = ("CREATE_PGM", "UPDATE_PGM")

# The default audit logic a mapping sheet carries for time and user.
DEFAULT_TIME_LOGIC = "CURRENT_TIMESTAMP()"
DEFAULT_USER_LOGIC = "CAST(CURRENT_USER() AS VARCHAR(200))"

# Columns a keyed merge never overwrites unless told otherwise.
DEFAULT_UPDATE_EXCLUDE = ("CREATE_DT", "CREATE_BY", "CREATE_PGM")

# Mapping-sheet artefact columns that are never projected.
SHEET_ARTEFACTS = ("LIST (Y,N)", "TABLE TYPE", "REF")

# The word in a logic that marks a sequence (surrogate key) column.
SEQUENCE_WORD = "NEXTVAL"

# Materialisations a mapping may ask for.
MATERIALIZATIONS = ("table", "view", "truncate_load", "lnd_load", "incremental")

# Loads this library adds to those: an INSERT of the model's rows, matched by name.
ADDED_MATERIALIZATIONS = ("insert",)

# The characters that mark a logic as computed rather than a plain
# column for the delta comparison, and the word that does the same.
COMPUTED_MARKERS = ("'", "(", " ", "+", "-", "*", "/", "||")
COMPUTED_WORD = "CASE"

# Name rules for choosing a merge key, in priority order after the
# declared keys: business-code suffix, then identifier suffixes and names.
KEY_CODE_SUFFIX = "_CD"
KEY_ID_SUFFIXES = ("_ID", "_KEY")
KEY_ID_NAMES = ("ID", "KEY")

# The alias prefix a mapping uses for its main relation.
MAIN_PREFIX = "main"
