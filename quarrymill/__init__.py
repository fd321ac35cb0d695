"""Curation and evaluation of labelled collections, as DataFrame -> DataFrame functions."""
