"""weftline.plans"""
