"""Training-data operators: search, de-duplication, classification, chat and
archive formats, tokenizing and packing.  Nothing else in the library imports
this subpackage."""
