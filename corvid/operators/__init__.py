"""corvid.operators"""
