"""corvid.sources"""
