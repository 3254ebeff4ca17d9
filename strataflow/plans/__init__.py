"""End-to-end flows composed of the operators.

The employee dimension has to be built before any fact.
"""
