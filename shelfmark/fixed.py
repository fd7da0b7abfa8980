"""Texts, word lists and formats that results must carry exactly."""

# --- status ---------------------------------------------------------------
STILL_PROCESSING = "This submission is still processing."
NO_LONGER_PROCESSING = "This submission is no longer processing."
NO_STATUS = "Error: No status found for this submission."

# --- validation -----------------------------------------------------------
TITLE_AND_AUTHORS_REQUIRED = "'title' and 'authors' are required arguments."
TITLE_REQUIRED = "'title' is a required arguments."
AUTHORS_REQUIRED = "'authors' is a required argument."
BLOCKS_REQUIRED = "You must populate the dc and data blocks before submission."
ALREADY_SUBMITTED = "You have already submitted this dataset. Set update=True to resubmit it"
TASK_NOT_FOUND = "Curation task not found"

# --- curation -------------------------------------------------------------
DEFAULT_REASONS = {
    "accept": "This submission has been accepted because it meets the appropriate standards",
    "reject": "This submission has been rejected because it does not meet the appropriate standards",
}
CURATION_SUMMARY = "%s by %s\nWaiting since %s\n%s\n"

# --- citation block -------------------------------------------------------
RESOURCE_TYPE = "Dataset"
DESCRIPTION_TYPE = "Other"
IDENTIFIER_TYPE = "DOI"
RELATION_TYPE = "IsPartOf"

# --- submissions ----------------------------------------------------------
TEST_PREFIX = "_test_"
PUBLIC = "public"
TABULAR_NA_VALUES = ["", " "]
# A metadata update does not carry these parts of a submission.
NOT_IN_METADATA_UPDATE = [
    "data_sources", "test", "update", "data_destinations", "index",
    "extraction_config", "services", "curation", "no_extract", "update_metadata_only",
]

# --- personal names -------------------------------------------------------
# Words that names are split by. The particles agree with the prefixes that the public nameparser
# library (LGPL) has by default, as family names have to begin where it lets them begin.
NAME_TITLES = [
    "dr", "mr", "mrs", "ms", "miss", "mx", "prof", "professor", "sir", "dame", "lord", "lady",
    "rev", "reverend", "fr", "father", "sister", "capt", "captain", "col", "colonel",
    "gen", "general", "lt", "lieutenant", "maj", "major", "sgt", "sergeant", "hon", "honorable",
]
NAME_SUFFIXES = [
    "jr", "jnr", "junior", "sr", "snr", "esq", "esquire", "ii", "iii", "iv",
    "phd", "md", "dds", "dvm", "jd", "mba", "msc", "bsc", "dphil", "edd", "cpa", "rn",
]
NAME_PARTICLES = [
    "abu", "al", "bin", "bon", "da", "dal", "de", "degli", "dei", "del", "dela", "della",
    "delle", "delli", "dello", "der", "di", "do", "dos", "du", "ibn", "la", "le", "mac", "mc",
    "san", "santa", "st", "ste", "van", "vander", "vel", "von", "vom",
]
