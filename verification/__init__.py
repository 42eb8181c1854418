"""Inputs and independent SQL answers for checking the library on the TPC-H-like test tables."""
