"""Operators that prepare a text corpus for language-model training.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames, keeps one row per input row unless its name says otherwise,
and reads only the columns it names, so further columns never clash.
"""
