"""Training-data operators; nothing outside this subpackage imports it.

Operators that keep the other columns of their input use names that begin with
_bw_ on the way; such columns in the input are not kept.
"""
