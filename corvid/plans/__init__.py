"""corvid.plans"""
