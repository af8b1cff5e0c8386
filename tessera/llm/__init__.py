"""Training-data operators: cleaning, deduplicating, scoring, mixing and
tokenising a corpus of documents.  Nothing else in the library imports
this subpackage."""
