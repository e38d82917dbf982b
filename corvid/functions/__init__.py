"""corvid.functions"""
