"""corvid.streaming"""
