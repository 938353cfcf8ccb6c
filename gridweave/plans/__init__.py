"""gridweave.plans"""
